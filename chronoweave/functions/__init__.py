"""Column-expression helpers (JVM-side, codegen-friendly)."""
from .expr import (blend, clip_unit, nan_array, round6, safe_div, shape_width,
                   unit_confidence, zero_pad3)
from .uri import normalize_uri, split_scheme, strip_fragment, uri_rest, uri_scheme

__all__ = ["blend", "clip_unit", "nan_array", "round6", "safe_div", "shape_width",
           "unit_confidence", "zero_pad3", "normalize_uri", "split_scheme",
           "strip_fragment", "uri_rest", "uri_scheme"]
