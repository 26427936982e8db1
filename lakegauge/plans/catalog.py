"""Fixed vocabulary of results: dimensions, layers, statuses."""

from __future__ import annotations

# Category labels by dimension number.
CATEGORIES = {
    1: "1. SCHEMA", 2: "2. VOLUME", 3: "3. FRESHNESS", 4: "4. MISSINGNESS", 5: "5. UNIQUENESS", 6: "6. INTEGRITY",
    7: "7. DISTRIBUTION", 8: "8. DATA CLEANLINESS & ENCODING", 9: "9. REKONSILIASI SUMBER",
    10: "10. FORMAT & PATTERN COMPLIANCE", 11: "11. COST & STORAGE SAFETY", 12: "12. LINEAGE & AUDITABILITY",
}
# Dimensions that count in a layer; any other layer uses the bronze set.
LAYER_DIMENSIONS = {"bronze": (2, 3, 9, 11, 12), "silver": (1, 4, 5, 6, 8, 10), "gold": (6, 7)}
DEFAULT_DIMENSIONS = LAYER_DIMENSIONS["bronze"]
# Verdicts and statuses.
FIT, UNFIT = "LAYAK", "TIDAK LAYAK"
PASSED, FAILED, ERROR = "LOLOS", "GAGAL", "ERROR"
BLOCKING, WARNING, SKIPPED = "blocking", "warning", "skipped"


def layer_dimensions(layer: str) -> tuple[int, ...]:
    return LAYER_DIMENSIONS.get(layer.lower(), DEFAULT_DIMENSIONS)
