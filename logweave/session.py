"""Session settings the library relies on.

Two SQL settings change results and are applied to every session the
library touches:

* ``spark.sql.variant.allowDuplicateKeys=true`` — a JSON object with a
  repeated key parses and the last value wins (the usual JSON reader
  behaviour) instead of the whole record failing to parse.
* ``spark.sql.legacy.timeParserPolicy=CORRECTED`` — date-time validity
  checks use the strict parser.
* ``spark.sql.session.timeZone=UTC`` — only for sessions built here, where
  nothing else is set; the time functions never depend on the session zone,
  they take explicit zone arguments.

Defaults never replace what the cluster or ``spark-submit`` sets; Java options
are added to those that are there.
"""

from __future__ import annotations

import os

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

REQUIRED_SQL_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    # strict calendar checks (a lenient legacy parser would accept 30 February)
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # JSON routing expressions generate large methods; HotSpot leaves
    # methods over 8000 bytecodes interpreted unless told otherwise, which
    # halves throughput of the envelope jobs (measured on J6).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting SQL settings to an existing session."""
    for k, v in REQUIRED_SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def _preset() -> dict[str, str]:
    """Settings that are there already: of a running session, or from ``spark-submit``."""
    active = SparkSession.getActiveSession()
    if active is not None:
        try:
            return dict(active.sparkContext.getConf().getAll())
        except Exception:  # a Connect session has no SparkContext
            return {}
    if SparkContext._gateway is None and "PYSPARK_GATEWAY_PORT" not in os.environ:
        return {}
    SparkContext._ensure_initialized()
    return dict(SparkConf(_jvm=SparkContext._jvm).getAll())


def merged_conf(defaults: dict[str, str], preset: dict[str, str]) -> dict[str, str]:
    """The defaults that are not set yet; Java options are appended to those set."""
    out = {}
    for k, v in defaults.items():
        if k not in preset:
            out[k] = v
        elif k.endswith("extraJavaOptions") and v not in preset[k]:
            out[k] = f"{preset[k]} {v}"
    return out


def build_session(master: str | None = None, app_name: str = "logweave",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is left to ``spark-submit`` when not given, so the same code
    runs on a cluster and in ``local[N]`` tests.
    """
    b = SparkSession.builder.appName(app_name)
    local = {}
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # Routing jobs are map-only; shuffle width only matters for the
            # grouped helpers and the optional file-spreading shuffle. On a
            # cluster it comes from the cluster's own setting (and AQE
            # coalesces small stages); locally it is the core count.
            n = master[len("local["):-1] if master.startswith("local[") else "1"
            local["spark.sql.shuffle.partitions"] = str(os.cpu_count() or 8) if n == "*" else n
    defaults = merged_conf({**DEFAULT_CONF, **local}, _preset())
    for k, v in {**defaults, **REQUIRED_SQL_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    return configure(spark)


def shared_dir(spark: SparkSession, name: str, default_root: str | None = None) -> str:
    """A folder for checkpoints/state under the cluster's shared checkpoint dir.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    (tests, local runs) is ``default_root`` used, and it is then also set on
    the session so later calls agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:  # a Spark Connect session has no SparkContext; the conf is enough there
        sc = spark.sparkContext
    except Exception:
        pass
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if default_root is None:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder "
                "(or pass default_root in local tests)")
        root = default_root
        spark.conf.set("spark.checkpoint.dir", root)
        if sc is not None:
            sc.setCheckpointDir(root)
    return os.path.join(root, name) if "://" not in root else root.rstrip("/") + "/" + name
