from .dedup import stream_dedup
from .loads import batch_loader, stream_load

__all__ = ["batch_loader", "stream_dedup", "stream_load"]
