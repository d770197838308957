"""``python -m goldpan <name> [arguments...]``, also as a spark-submit main.

The names are those of the single jobs and of the workflows below. Arguments go by
position or as ``name=value``; a value may be JSON (``lexicon=["good","fine"]``), a schema
is written as columns (``payload="userId bigint, score double"``).
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from goldpan.operators.tables import drop_table
from goldpan.plans import workflows
from goldpan.plans.jobs import JOBS
from goldpan.session import build_session

COMMANDS = {
    **JOBS,
    "load": workflows.load_purchases,
    "export": workflows.export_purchases,
    "drop": drop_table,
    "jobs": workflows.run_jobs,
    "all": workflows.bronze_to_gold,
}


ALL_ROWS = 2**31 - 1


def _parsed(arguments: list[str]) -> tuple[list[str], dict[str, object]]:
    """Positional values, and ``name=value`` options whose values may be JSON."""
    values, options = [], {}
    for argument in arguments:
        name, equals, value = argument.partition("=")
        if not (equals and name.isidentifier()):
            values.append(argument)
            continue
        try:
            options[name] = json.loads(value)
        except ValueError:
            options[name] = value
    for name in ("payload", "log_payload", "schema"):
        if isinstance(options.get(name), str):
            options[name] = T._parse_datatype_string(options[name])
    return values, options


def main(arguments: list[str]) -> None:
    if not arguments or arguments[0] not in COMMANDS:
        raise SystemExit(f"usage: python -m goldpan <{'|'.join(COMMANDS)}> [arguments...]")
    name, values, options = arguments[0], *_parsed(arguments[1:])
    result = COMMANDS[name](build_session(), *values, **options)
    if isinstance(result, DataFrame):
        # what is shown was limited by the job; results of other jobs are only sampled
        result.show(ALL_ROWS if name == "show" else 20, truncate=False)
    elif result is not None:
        print(result)


if __name__ == "__main__":
    main(sys.argv[1:])
