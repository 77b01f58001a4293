"""Jobs around a pipeline: land deliveries and update, and check that doing it again changes nothing."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame

from mandrel.operators.verify import compare, fingerprints
from mandrel.streaming import ingest

#: An update of all data sets; with True everything is built again from the raw files.
Update = Callable[[bool], None]


def spark_pipelines(spec: str, command: Sequence[str] = ("spark-pipelines",)) -> Update:
    """Updates by Spark's own runner."""

    def update(full_refresh: bool) -> None:
        subprocess.run([*command, "run", "--spec", spec, *(["--full-refresh-all"] if full_refresh else [])], check=True)

    return update


def replay(update: Update, staging: str, inbox: str, dates: Iterable[str], single_update: bool = False) -> None:
    """Land dates and update, once for each or once for all."""
    for d in dates:
        ingest.land(staging, inbox, d)
        if not single_update:
            update(False)
    if single_update:
        update(False)


def idempotent(update: Update, read: Callable[[str], DataFrame], tables: Iterable[str], staging: str, inbox: str, dates: Sequence[str]) -> dict[str, list[str]]:
    """Tables that change when dates come again, and when everything is built again; both lists should be empty."""
    names = list(tables)
    now = lambda: fingerprints({n: read(n) for n in names})
    before = now()
    replay(update, staging, inbox, dates)
    again = now()
    update(True)
    return {"rerun": compare(before, again), "rebuild": compare(before, now())}
