"""Scalar expressions (JVM-side compositions of built-in functions)."""

from .scalars import (PLATFORM_LABELS, initcap_delims, label_map, local_datetime,
                      platform_label, string_key, typed_cast, utc_date)

__all__ = ["PLATFORM_LABELS", "initcap_delims", "label_map", "local_datetime",
           "platform_label", "string_key", "typed_cast", "utc_date"]
