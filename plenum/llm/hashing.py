"""Words, shingles and their 64-bit hashes: see ``plenum.functions.hashing``, which other queries use as well."""

from ..functions.hashing import _BYTES, _UPPER, MIX1, MIX2, STEP, U, in_slices, mix, ngram_hashes, places, powers, run_sums, shingle_sets, word_bounds

__all__ = ["MIX1", "MIX2", "STEP", "U", "_BYTES", "_UPPER", "in_slices", "mix", "ngram_hashes", "places", "powers", "run_sums", "shingle_sets", "word_bounds"]
