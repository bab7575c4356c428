"""URL verdicts from a trie over reversed host labels and path segments."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Bytes of rules that may be broadcast; a larger list is refused before anything runs.
MAX_RULE_BYTES = 64_000_000
DEFAULT_VERDICT = "allow"


@dataclass
class Node:
    """``labels``: next host label to the left. ``segments``: next whole path segment.
    ``partial``: (last piece of a rule's path, rule, verdict), longest first."""

    labels: dict[str, Node] = field(default_factory=dict)
    segments: dict[str, Node] = field(default_factory=dict)
    partial: list[tuple[str, str, str]] = field(default_factory=list)


def build(rules: Iterable[tuple[str, str, str]]) -> Node:
    """Trie of (verdict, host, path) rules; on equal host and path a block outranks an allow."""
    root = Node()
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.lower().split(".")) if host else ():
            node = node.labels.setdefault(label, Node())
        *whole, last = path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        node.partial.append((last, host + path, verdict))
    stack = [root]
    while stack:
        node = stack.pop()
        node.partial.sort(key=lambda r: (-len(r[0]), r[2] != "block"))
        stack += [*node.labels.values(), *node.segments.values()]
    return root


def _in_path(node: Node, path: str) -> tuple[str, str] | None:
    found, rest = None, path
    while True:
        for last, rule, verdict in node.partial:
            if rest.startswith(last):
                found = (rule, verdict)
                break
        head, slash, rest = rest.partition("/")
        node = node.segments.get(head) if slash else None
        if node is None:
            return found


def judge(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule: most host labels first, then the longest path."""
    at, trail = root, [root]
    for label in reversed(host.split(".")):
        at = at.labels.get(label)
        if at is None:
            break
        trail.append(at)
    for node in reversed(trail):
        if found := _in_path(node, path):
            return found
    return None


def url_parts(url: str):
    """Host and path columns of a url column; both empty for null or without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, capitals, small), F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    keep: list[str],
    url: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """Columns ``keep`` of every row with ``host``, ``path``, ``rule`` and ``verdict``.

    The rules go to the tasks as one broadcast whose size is checked. A url without a fitting
    rule has a null rule and the ``default`` verdict; so has one that is null or has no ``://``
    (unless a rule for the empty host exists). Rows are judged one by one: repeated rows give
    repeated results, an empty table gives none, and names in ``keep`` may not clash with the
    four new columns.
    """
    spark = pages.sparkSession
    packed = json.dumps(rules)
    if len(packed) > MAX_RULE_BYTES:
        raise ValueError(f"rules take {len(packed)} bytes; {MAX_RULE_BYTES} can be broadcast")
    shared = spark.sparkContext.broadcast(packed)
    host, path = url_parts(url)
    parted = pages.select(*keep, host.alias("host"), path.alias("path"))
    schema = StructType(list(parted.schema.fields)).add("rule", StringType()).add("verdict", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = build(json.loads(shared.value))
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            got = [judge(root, h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([g and g[0] for g in got], pa.string()),
                    pa.array([g[1] if g else default for g in got], pa.string()),
                ],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    return parted.mapInArrow(run, schema)
