from siltstone.functions.scalars import (
    base_name,
    decode_path,
    growth_pct,
    label_codes,
    pct,
)

__all__ = ["base_name", "decode_path", "growth_pct", "label_codes", "pct"]
