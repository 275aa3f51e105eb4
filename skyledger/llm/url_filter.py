"""URL filters: host and path rules, met by a sorted sweep over reversed hosts.

A host's canonical key is its labels in reverse, each followed by a dot: ``example.net`` gives
``net.example.``.  The subdomains of a rule's host are then the keys that begin with the rule's key: an
interval.  Rules and hosts are sorted by key and swept together; a stack holds the rules whose
interval is open, each nested in the one below.  What lies on the stack fits the host; the longest of
these rules whose path begins the url's path decides.  Ties, which need rules of one length, go to the
longer host.

With at most ``SMALL`` rules, every task sweeps its own rows, sorted a batch at a time, and nothing is
shuffled.  With more, the different hosts and the rules are range-partitioned by key and swept
together; the rules that are open where a partition begins are the ones whose key begins its first key, and are
handed to it.  Then each page joins the rules of its host.

A null url, or one without ``://``, has empty host and path and fits no rule.  Where no rule fits, the
verdict is ``default``.  Repeated rules count once; of rules that differ only in the action, block wins.
Repeated pages are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import partitions, saved

#: Rules that every task may hold: a few megabytes.
SMALL = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def reversed_host(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, _UPPER, _LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    path = F.regexp_extract(F.substr(rest, F.length(F.regexp_extract(rest, r"^[^/?#]*", 0)) + 1), r"^[^?#]*", 0)
    return F.when(at > 0, path).otherwise("")


def _ordered(rules: Sequence[Rule]) -> list[Rule]:
    """The order in which rules that fit are tried."""
    return sorted(set(rules), key=lambda r: (-len(r.text), -len(r.host), r.text, r.action != "block"))


def sweep(events: Iterator[tuple[str, list[Rule] | None]], stack: list[tuple[str, list[Rule]]]) -> Iterator[tuple[str, list[Rule]]]:
    """From keys in order, rules before hosts of the same key, each host's key and the rules on the stack."""
    for key, rules in events:
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if rules is not None:
            stack.append((key, rules))
        elif stack:
            yield key, _ordered([r for _, held in stack for r in held])


def _merged(hosts: Sequence[str], rules: Sequence[tuple[str, list[Rule]]]) -> Iterator[tuple[str, list[Rule] | None]]:
    k = 0
    for host in hosts:
        while k < len(rules) and rules[k][0] <= host:
            yield rules[k]
            k += 1
        yield host, None


def _by_key(rules: Sequence[Rule]) -> list[tuple[str, list[Rule]]]:
    held: dict[str, list[Rule]] = {}
    for r in rules:
        held.setdefault(reversed_host(r.host), []).append(r)
    return sorted(held.items())


def _judged_in_tasks(urls: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    sent = urls.sparkSession.sparkContext.broadcast(_by_key(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts = b.column("host").dictionary_encode()
            names = hosts.dictionary.to_pylist()
            keys = [reversed_host(h) for h in names]
            fitting = dict(sweep(_merged(sorted(set(keys)), sent.value), []))
            by_host = [fitting.get(k, ()) if h else () for h, k in zip(names, keys, strict=True)]
            texts, verdicts = [], []
            for h, path in zip(hosts.indices.to_pylist(), b.column("path").to_pylist(), strict=True):
                hit = next((r for r in by_host[h] if path.startswith(r.path)), None)
                texts.append(hit.text if hit else None)
                verdicts.append(hit.action if hit else default)
            yield pa.record_batch([*b.columns, pa.array(texts, pa.string()), pa.array(verdicts, pa.string())], names=[*b.schema.names, "rule", "verdict"])

    return urls.mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string")


_FITS = "host string, rules array<struct<action:string,host:string,path:string>>"
_FITS_ARROW = pa.list_(pa.struct([("action", pa.string()), ("host", pa.string()), ("path", pa.string())]))


def _key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _judged_by_ranges(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    spark = urls.sparkSession
    hosts = urls.where("host <> ''").select("host").distinct().select(_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("action"), "host", F.lit("").alias("path"))
    both = rules.select(_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), "action", "host", "path").unionByName(hosts)
    order = ["key", "kind", "path", "action"]
    # By key alone: what has one key stays together, a host with its own rules.
    placed = both.repartitionByRange(partitions(spark), "key").sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed = saved(placed, "ranges")
    first = placed.groupBy("part").agg(F.min("key").alias("start"))  # a row for each partition
    labels = F.split("start", r"\.", -1)
    above = first.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda k: F.concat(F.array_join(F.slice(labels, 1, k), "."), F.lit(".")))).alias("key"), "start").where("key <> start")
    carried = placed.where("kind = 0").drop("part").join(above.drop("start"), "key").select("part", *order, "host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def events() -> Iterator[tuple[str, list[Rule] | None]]:
            for b in batches:
                for key, kind, action, host, path in zip(*(b.column(x).to_pylist() for x in ("key", "kind", "action", "host", "path")), strict=True):
                    yield key, [Rule(action, host, path)] if kind == 0 else None

        waiting: list[tuple[str, list[Rule]]] = []

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([reversed_host(k[:-1])[:-1] for k, _ in waiting], pa.string()), pa.array([[r._asdict() for r in rs] for _, rs in waiting], _FITS_ARROW)], names=["host", "rules"])

        stack: list[tuple[str, list[Rule]]] = []
        for found in sweep(events(), stack):
            waiting.append(found)
            if len(waiting) == 1000:
                yield out()
                waiting = []
        if waiting:
            yield out()

    whole = placed.unionByName(carried)
    parts = partitions(spark)
    fits = whole.repartition(parts, "part").sortWithinPartitions("part", *order).mapInArrow(run, _FITS)
    joined = urls.join(fits, "host", "left")
    hit = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    chosen = F.get(hit, F.lit(0))
    return joined.select("page_id", "host", "path", chosen.alias("hit")).select(
        "page_id", "host", "path", F.concat("hit.host", "hit.path").alias("rule"), F.coalesce("hit.action", F.lit(default)).alias("verdict")
    )


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url", small: int = SMALL) -> DataFrame:
    """One row for each page: page_id, host, path, rule (host and path, or null), verdict.

    ``rules`` are (action, host, path), as rows or as a table with these columns.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    urls = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    if isinstance(rules, DataFrame):
        table = rules.select("action", F.translate("host", _UPPER, _LOWER).alias("host"), "path").where("host is not null and path is not null").distinct()
        head = table.limit(small + 1).collect()
        if len(head) > small:
            return _judged_by_ranges(urls, table, default)
        rules = [tuple(r) for r in head]
    return _judged_in_tasks(urls, [Rule(a, h.translate(str.maketrans(_UPPER, _LOWER)), p) for a, h, p in rules], default)
