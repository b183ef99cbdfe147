"""Streaming: intentionally empty.

The reference reads whole files in batch only (no stream, watermark, window
or state anywhere), so there is no streaming operator to rebuild.  New
catalog files are handled by rerunning the batch jobs in ``larder.plans.jobs``
(each job overwrites its written outputs).
"""
