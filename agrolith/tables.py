"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .streaming.events import shared

#: A side of at most so many rows, which a bounded count tells, may be broadcast.
BROADCAST_ROWS = 100_000


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame's rows as a table in the shared folder, read again: computed once, lineage cut, and the same rows for
    every reader, whichever executor is lost meanwhile."""
    path = shared(frame.sparkSession, f"agrolith-{purpose}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def scanned(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame if it is a scan of files with projections and filters, which is as good to read again as a copy of it;
    any other frame is stored."""
    nodes, names = [frame._jdf.queryExecution().optimizedPlan()], set()
    while nodes:
        node = nodes.pop()
        names.add(node.nodeName().split(" ")[0])
        children = node.children()
        nodes += [children.apply(at) for at in range(children.size())]
    return frame if names <= {"Project", "Filter", "LogicalRelation", "Relation"} else stored(frame, purpose)
