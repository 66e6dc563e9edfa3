"""Run one routing job as a process, batch or streaming.

    spark-submit --py-files logweave.zip logweave/cli.py filebeat_dlq \\
        --source s3://bucket/topics --sink s3://bucket/routed \\
        --pattern 'test-.*' --param sink=s3-archive --param error_topic=dead-letter --stream

Job parameters (topic names, prefixes, zone, error policy) are passed as
``--param name=value``; ``--source kafka://host:port`` reads Kafka instead
of a topic directory table, and ``--sink kafka://host:port`` writes each
record to the Kafka topic named in its ``topic`` column (both need the
Kafka connector); ``--sink-option name=value`` sets producer options.
"""

from __future__ import annotations

import argparse
import inspect
import os
import sys

if __package__ in (None, ""):  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logweave.functions import jsoncols as J
from logweave.functions import timecols as T
from logweave.operators.sizes import MAX_REQUEST_SIZE, TOO_LARGE_FOR_SINK, within_limit
from logweave.plans import jobs
from logweave.session import build_session
from logweave.sources.records import read_kafka, read_topics
from logweave.streaming.sinks import (kafka_sink_options, start_routed_kafka_stream, start_routed_stream,
                                      write_routed, write_routed_kafka)

# The deployment environment variables the reference's apps
# read, and the job parameter each one sets (used with --from-env).
ENV_PARAMS = {
    "INPUT_TOPIC": "topic",
    "INPUT_TOPIC_REGEX": "pattern",
    "OUTPUT_TOPIC_S3": "sink",
    "ERROR_TOPIC": "error_topic",
    "TOPIC_PREFIX": "topic_prefix",
    "TZ": "zone",
}

JOBS = {
    "chat_rekey": jobs.chat_rekey, "log_split": jobs.log_split, "chat_extract": jobs.chat_extract,
    "daily_feed": jobs.daily_feed, "filebeat_dlq": jobs.filebeat_dlq, "two_level_dlq": jobs.two_level_dlq,
    "db_feed": jobs.db_feed, "monthly_split": jobs.monthly_split, "validate_pass": jobs.validate_pass,
}


def _value(text: str, default):
    """A parameter's text as the type of its default: list (comma-separated), number, boolean or text."""
    if isinstance(default, bool):
        if text.lower() not in ("true", "false"):
            raise SystemExit(f"not true or false: {text}")
        return text.lower() == "true"
    if isinstance(default, int):
        return int(text)
    if isinstance(default, (list, tuple)):
        return [x for x in text.split(",") if x]
    return text


def typed(name: str, params: dict[str, str]) -> dict:
    """Parameters of a job converted by the types of their defaults."""
    accepted = inspect.signature(JOBS[name]).parameters
    return {k: _value(v, accepted[k].default) if k in accepted else v for k, v in params.items()}


def env_params(name: str, environ=None) -> dict:
    """Job parameters from the deployment environment, for the parameters
    the job accepts."""
    environ = os.environ if environ is None else environ
    accepted = inspect.signature(JOBS[name]).parameters
    return {param: environ[var] for var, param in ENV_PARAMS.items()
            if var in environ and param in accepted}


def job_callable(name: str, params: dict):
    fn = JOBS[name]
    accepted = inspect.signature(fn).parameters
    unknown = set(params) - set(accepted)
    if unknown:
        raise SystemExit(f"unknown parameter(s) for {name}: {sorted(unknown)}; accepted: {sorted(accepted)[1:]}")
    return lambda records: fn(records, **params)


_CLEANUP: list = []


#: Dead-letter reasons that ``--metrics`` counts one by one.
REASONS = (J.INVALID_JSON, J.FILEBEAT_ERROR, J.FLUENTBIT_ERROR, J.TRANSFORM_ERROR, J.TOPIC_ERROR, J.TOO_LARGE, J.BEYOND_LIMITS,
           J.NOT_UTF8, TOO_LARGE_FOR_SINK)


def _with_metrics(spark, routed, stream: bool, error_topic: str):
    """Counts, not per-record logs: one line per micro-batch (stream) or run."""
    from pyspark.sql import Observation
    from pyspark.sql.streaming import StreamingQueryListener

    from logweave.operators.grouped import observe_routes

    if stream:
        class Printer(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                m = event.progress.observedMetrics.get("routes")
                if m is not None:
                    print(f"batch {event.progress.batchId}: " + " ".join(f"{k}={v}" for k, v in m.asDict().items()), flush=True)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        printer = Printer()
        spark.streams.addListener(printer)
        _CLEANUP.append(lambda: spark.streams.removeListener(printer))
        return observe_routes(routed, "routes", error_topic, reasons=REASONS)
    obs = Observation("routes")
    routed = observe_routes(routed, obs, error_topic, reasons=REASONS)
    import atexit
    atexit.register(lambda: print(f"routes: {obs.get}", flush=True))
    return routed


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--source", required=True, help="topic table root, or kafka://host:port")
    ap.add_argument("--sink", required=True, help="routed output root (topic=<name>/ layout)")
    ap.add_argument("--pattern", help="topic regex subscription (overrides the job default)")
    ap.add_argument("--topic", help="single topic subscription (overrides the job default)")
    ap.add_argument("--param", action="append", default=[], help="job parameter name=value")
    ap.add_argument("--source-option", action="append", default=[],
                    help="source option name=value: Kafka consumer or source options, file stream options")
    ap.add_argument("--sink-option", action="append", default=[], help="Kafka producer option name=value")
    ap.add_argument("--stream", action="store_true", help="run as a streaming query")
    ap.add_argument("--trigger", help="processing-time trigger, e.g. '30 seconds' (default: available now)")
    ap.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--starting-offsets", default="earliest", choices=["earliest", "latest"])
    ap.add_argument("--metrics", action="store_true",
                    help="observe rows and dead letters per run or micro-batch and print them")
    ap.add_argument("--from-env", action="store_true",
                    help="take topic/pattern/sink/error topic/prefix/zone from the deployment "
                         "environment (" + ", ".join(ENV_PARAMS) + ")")
    a = ap.parse_args(argv)

    params = env_params(a.job) if a.from_env else {}
    params.update(typed(a.job, dict(p.split("=", 1) for p in a.param)))
    params.setdefault("metadata", True)
    if a.pattern:
        params["pattern"] = a.pattern
    if a.topic:
        params["topic"] = a.topic
    job = job_callable(a.job, params)
    options = dict(o.split("=", 1) for o in a.source_option)
    if a.starting_offsets == "latest" and not a.source.startswith("kafka://"):
        raise SystemExit("--starting-offsets latest needs a Kafka source; a file source starts with the files that are there")
    spark = build_session(app_name=f"logweave-{a.job}")

    if a.source.startswith("kafka://"):
        # subscribe to what the job selects (its default topic/pattern unless overridden)
        defaults = {k: p.default for k, p in inspect.signature(JOBS[a.job]).parameters.items()}
        topic = params.get("topic", defaults.get("topic"))
        pattern = params.get("pattern", defaults.get("pattern"))
        records = read_kafka(spark, a.source[len("kafka://"):], None if pattern else topic, pattern,
                             a.starting_offsets, stream=a.stream, extra=options)
    elif a.stream:
        from logweave.sources.records import read_topics_stream
        records = read_topics_stream(spark, a.source, options=options)
    else:
        records = read_topics(spark, a.source)
    routed = job(records)
    error_topic = params.get("error_topic", "dead-letter")
    opts = {}
    if a.sink.startswith("kafka://"):
        opts = kafka_sink_options(a.sink[len("kafka://"):], extra=dict(o.split("=", 1) for o in a.sink_option))
        limit = int(opts.get("kafka.max.request.size", MAX_REQUEST_SIZE))
        routed = within_limit(routed, T.now_iso(params.get("zone", T.DEFAULT_ZONE)), limit, error_topic)
    if a.metrics:
        routed = _with_metrics(spark, routed, a.stream, error_topic)

    if opts:
        if a.stream:
            start_routed_kafka_stream(routed, opts, a.checkpoint, a.job, a.trigger).awaitTermination()
        else:
            write_routed_kafka(routed, opts)
    elif a.stream:
        start_routed_stream(routed, a.sink, a.checkpoint, a.job, processing_time=a.trigger).awaitTermination()
    else:
        write_routed(routed, a.sink)
    if _CLEANUP:
        import time
        time.sleep(1)                      # let the last progress event reach the listener
        while _CLEANUP:
            _CLEANUP.pop()()


if __name__ == "__main__":
    main()
