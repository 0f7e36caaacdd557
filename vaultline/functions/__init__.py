from .keys import as_text, hash_diff, hash_key, hash_of, with_hash
from .temporal import add_days, add_hours, add_minutes, day_of, ntz_now

__all__ = ["as_text", "hash_diff", "hash_key", "hash_of", "with_hash",
           "add_days", "add_hours", "add_minutes", "day_of", "ntz_now"]
