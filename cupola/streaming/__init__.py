from cupola.streaming.coupons import band_counts_stream, normalise_stream, write_stream

__all__ = ["band_counts_stream", "normalise_stream", "write_stream"]
