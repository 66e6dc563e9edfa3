"""Plan inspection helpers used by tests and the benchmark.

They read the formatted physical plan and report the things a routing job
must not have: shuffles (``Exchange``), Python evaluation nodes, and more
than one JSON parse of the same text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_NODE = re.compile(r"^\((\d+)\) (.+?)$", re.M)


def formatted_plan(df: DataFrame) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def node_sections(plan: str) -> list[tuple[str, str]]:
    """``[(node name, section text)]`` of a formatted plan."""
    marks = list(_NODE.finditer(plan))
    out = []
    for i, m in enumerate(marks):
        end = marks[i + 1].start() if i + 1 < len(marks) else len(plan)
        out.append((m.group(2), plan[m.end():end]))
    return out


def _calls(text: str, fn: str) -> set[str]:
    """Distinct ``fn(...)`` call texts (balanced parentheses) in ``text``."""
    found = set()
    for m in re.finditer(re.escape(fn) + r"\(", text):
        depth, j = 0, m.end() - 1
        while j < len(text):
            if text[j] == "(":
                depth += 1
            elif text[j] == ")":
                depth -= 1
                if depth == 0:
                    break
            j += 1
        found.add(text[m.start():j + 1])
    return found


def plan_stats(df: DataFrame) -> dict:
    """Counts over the physical plan: exchanges, python nodes, parses.

    ``parses`` is the number of distinct parse expressions per operator,
    summed over operators — identical expressions inside one operator are
    evaluated once (subexpression elimination), so this is the number of
    times a record's text is parsed.
    """
    plan = formatted_plan(df)
    sections = node_sections(plan)
    parses = 0
    for name, text in sections:
        body = "\n".join(l for l in text.splitlines() if not l.startswith("Input"))
        parses += len(_calls(body, "VariantExpressionEvalUtils.parseJson"))
    outside = ("Scan", "ColumnarToRow", "Exchange", "AdaptiveSparkPlan", "AQEShuffleRead")
    return {
        # operators running outside whole-stage codegen (interpreted row by row)
        "codegen_gaps": sum(1 for n, t in sections
                            if not any(n.startswith(o) for o in outside) and "[codegen id" not in n),
        "exchanges": sum(1 for n, _ in sections if "Exchange" in n),
        "python_nodes": sum(1 for n, _ in sections if "Python" in n or "ArrowEval" in n),
        "parses": parses,
        "pushed_filters": re.findall(r"PushedFilters: \[(.*?)\]", plan),
        "partition_filters": re.findall(r"PartitionFilters: \[(.*?)\]", plan),
        "read_schema": re.findall(r"ReadSchema: (.*)", plan),
    }
