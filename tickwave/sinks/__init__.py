"""Writers: envelopes, the shared candle table, the rate dimension, summaries."""
