"""Structured Streaming forms of the operators.

Every query writes through ``foreachBatch`` into folders keyed by batch id, so a batch
that is run again after a failure replaces its own rows. What one batch hands to the
next (a frontier, running totals, events to retry) is a small table of the batch before.
"""
