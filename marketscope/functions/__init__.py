from marketscope.functions.expressions import (
    classify_section, division, full_id, lenient_bigint, lenient_real, ratio, section_of, size_or_unknown,
    split_codes, tax_regime,
)
from marketscope.functions.sections import REGIME_ROWS, SECTIONS, SIZE_ROWS

__all__ = [
    "classify_section", "division", "full_id", "lenient_bigint", "lenient_real", "ratio", "section_of",
    "size_or_unknown", "split_codes", "tax_regime", "SECTIONS", "SIZE_ROWS", "REGIME_ROWS",
]
