"""Captured pages and their element lists."""

from __future__ import annotations

import gc
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from excursio.schemas import NODES, parsed
from excursio.sources.markup import PageTree

# Executors get the code with the task; the package need not be installed there.
for _module in ("excursio.sources.markup", __name__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

# Output batches are cut by markup size: a run of huge pages cannot pile up, and
# Spark works on one batch while the next one is being parsed.
_BATCH_CHARS = 1 << 20


def read_pages(spark: SparkSession, location: str) -> DataFrame:
    """``page_id, url, html`` of captured pages stored as Parquet."""
    return spark.read.parquet(location).select("page_id", "url", "html")


def spread(df: DataFrame, partitions: int | None = None, key: str = "page_id") -> DataFrame:
    """Deal the rows to so many partitions; without a number they stay where they are.

    For inputs of few splits and many cores. It moves all markup, which on a large
    input would be the most costly shuffle of the job. ``key`` must be (nearly) unique.
    """
    return df if partitions is None else df.repartition(partitions, key)


def page_rejects(pages: DataFrame) -> DataFrame:
    """Pages without address or markup: reported, not parsed."""
    return pages.filter(F.col("url").isNull() | F.col("html").isNull()).select(
        "page_id",
        "url",
        F.when(F.col("url").isNull(), "no url").otherwise("no html").alias("reason"),
    )


def page_nodes(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by ``page_text`` and ``nodes``; other columns stay."""
    kept = [f for f in pages.schema.fields if f.name != "html"]
    added = parsed(f"page_text BINARY, nodes {NODES}").fields
    schema = T.StructType(kept + added)
    names = [f.name for f in kept]

    def to_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Left out here: Spark would move a filter below the making of the markup and the dealing
            # of its rows, and so make all markup once more in the few tasks that read them.
            url, html = (batch.column(batch.schema.get_field_index(n)) for n in ("url", "html"))
            batch = batch.filter(pc.and_(url.is_valid(), html.is_valid()))
            html = batch.column(batch.schema.get_field_index("html"))
            begin = 0
            while begin < batch.num_rows:
                trees = _trees(html, begin)
                yield _emit(batch.slice(begin, len(trees)), names, trees)
                begin += len(trees)

    return pages.mapInArrow(to_nodes, schema)


def _trees(html: pa.Array, begin: int) -> list[PageTree]:
    """Pages from ``begin`` on, up to the size of an output batch.

    Trees hold no cycles, and looking for some among so many lists takes a tenth of the time.
    """
    trees: list[PageTree] = []
    chars, looking = 0, gc.isenabled()
    gc.disable()
    try:
        for i in range(begin, len(html)):
            source = html[i].as_py()
            trees.append(PageTree(source))
            chars += len(source)
            if chars >= _BATCH_CHARS:
                break
    finally:
        if looking:
            gc.enable()
    return trees


def _emit(batch: pa.RecordBatch, names: list[str], trees: list[PageTree]) -> pa.RecordBatch:
    lengths = np.array([len(t.tag) for t in trees], np.int32)
    total = int(lengths.sum())

    def flat(field: str) -> Iterator:
        return chain.from_iterable(getattr(t, field) for t in trees)

    def ints(field: str) -> np.ndarray:
        return np.fromiter(flat(field), np.int32, total)

    def offsets(sizes: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)

    first = np.repeat(offsets(lengths)[:-1], lengths)
    tag, parent = pa.array(list(flat("tag")), pa.string()), ints("parent")
    # Siblings in order, page by page: the one before is the one before in this order.
    below = np.flatnonzero(parent >= 0)
    up = parent[below] + first[below]
    order = np.argsort(up, kind="stable")
    again = np.flatnonzero(up[order][1:] == up[order][:-1])
    before = np.full(total, -1)
    before[below[order[again + 1]]] = below[order[again]]

    attrs = list(flat("attrs"))
    some = list(filter(None, attrs))
    attr_map = pa.MapArray.from_arrays(
        pa.array(offsets(np.fromiter(map(len, attrs), np.int32, total))),
        pa.array(list(chain.from_iterable(some)), pa.string()),
        pa.array(list(chain.from_iterable(map(dict.values, some))), pa.string()),
    )
    # An element lies in all that began before it but for those that ended before it.
    place, size = np.arange(total), ints("size")
    ended = np.cumsum(np.bincount(place + size + 1, minlength=total + 1))[:total]
    fields = {
        "pre": pa.array(place.astype(np.int32) - first),
        "size": pa.array(size),
        "parent": pa.array(parent),
        "depth": pa.array((place - ended).astype(np.int32)),
        "n_children": pa.array(np.bincount(up, minlength=total).astype(np.int32)),
        "prev_tag": tag.take(pa.array(before, mask=before < 0)),
        "tag": tag,
        "attrs": attr_map,
        "t0": pa.array(ints("t0")),
        "t1": pa.array(ints("t1")),
    }
    nodes = pa.ListArray.from_arrays(
        pa.array(offsets(lengths)), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
    text = pa.array([t.text for t in trees], pa.binary())
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*columns, text, nodes], [*names, "page_text", "nodes"])
