"""logweave: JSON log routing on Spark (batch and Structured Streaming).

Start from :func:`logweave.session.build_session`, read records with
:mod:`logweave.sources.records`, run a job from :mod:`logweave.plans.jobs`
(or compose :mod:`logweave.operators.route` yourself) and write with
:mod:`logweave.streaming.sinks`.
"""

__version__ = "0.1.0"
