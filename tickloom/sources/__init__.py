"""Readers: candle files, tick tables, message streams, reference lists."""
