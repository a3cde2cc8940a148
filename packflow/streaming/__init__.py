"""Streaming: intentionally empty.

The reference has no streaming input (no watermarks, windows over event
time, or stateful operators; real-time ingestion is a stated limitation), so
nothing is built here. Every operator in ``packflow.operators`` is a plain
DataFrame transformation and would run unchanged inside a
``foreachBatch`` sink should a stream of daily panels ever be added.
"""
