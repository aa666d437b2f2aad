"""Continuous maintenance: storage layout, foreachBatch upserts of silver and
gold, watermark-bounded bars, the end-to-end streams and their lifecycle."""
