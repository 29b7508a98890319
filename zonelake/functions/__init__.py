"""Column expressions used across the library (all JVM-side built-ins)."""

from zonelake.functions.columns import epoch_millis, floor_to, json_int, key_struct

__all__ = ["epoch_millis", "floor_to", "json_int", "key_struct"]
