"""Streaming.

The reference works on batch tables only (no readStream / writeStream /
watermark anywhere), so no streaming operator is built.  Every feature
plan in ``leadtime.plans.features`` is a pure DataFrame -> DataFrame
function; a caller who receives data as a stream can apply it per
micro-batch through ``writeStream.foreachBatch`` without further code.
"""
