"""Allow and block rules on hosts and path prefixes, by a sort-merge range join.

The canonical key of a URL is its host with the labels reversed, each closed by a separator, then its
path. All hosts below a rule's host then lie in one interval of keys. URLs are dealt to key ranges whose
bounds come from a sample of the keys (they decide the balance, never the result), with a hash of the id
at the end of the key so that one URL in countless rows is spread too. A rule goes to every range that
its interval touches. Each range is sorted and swept once with a stack of the rules that are open at
that key: the rules of ``org``, within them those of ``example.org``, and so on.
"""

from __future__ import annotations

import bisect
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SEPARATOR = "\x01"
_PATH = "\x02"
_TOP = "\U0010ffff"
#: Ranges at most: the driver and the tasks hold their bounds. Beyond that a range is shared out by a hash of the id.
_RANGES = 1024


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _reversed(host: str) -> str:
    return "".join(label + SEPARATOR for label in reversed(host.split(".")))


def _key(host: Column, path: Column, tie: Column) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, SEPARATOR), F.lit(SEPARATOR + _PATH), path, F.lit(_PATH), F.hex(F.xxhash64(tie)))


class _Open(NamedTuple):
    """Rules of one host, open while the sweep is below it."""

    prefix: str
    host: str
    paths: dict[str, tuple[str, str]]
    lengths: list[int]


def _sweep(urls: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
    """Rows of one range with the longest rule that fits each, and its verdict."""
    hosts: dict[str, dict[str, tuple[str, str]]] = {}
    for host, path, verdict in rules[["host", "path", "verdict"]].itertuples(index=False):
        hosts.setdefault(host, {})[path] = (host + path, verdict)
    starts = sorted(
        (_Open(_reversed(h), h, p, sorted({len(x) for x in p}, reverse=True)) for h, p in hosts.items()),
        key=lambda o: o.prefix)
    urls = urls.sort_values("key", kind="stable")
    found, stack, at = [], [], 0
    last = verdict = None
    for key, host, path in urls[["key", "host", "path"]].itertuples(index=False):
        if (host, path) != last:
            last, verdict = (host, path), (None, None)
            while at < len(starts) and starts[at].prefix <= key:
                while stack and not starts[at].prefix.startswith(stack[-1].prefix):
                    stack.pop()
                stack.append(starts[at])
                at += 1
            while stack and not key.startswith(stack[-1].prefix):
                stack.pop()
            best = -1
            for rule in stack:
                if host != rule.host and not host.endswith("." + rule.host):
                    continue  # a separator inside a label only looks like a dot
                for n in rule.lengths:
                    hit = rule.paths.get(path[:n]) if n <= len(path) else None
                    if hit:
                        if len(hit[0]) > best:
                            best, verdict = len(hit[0]), hit
                        break
        found.append(verdict)
    columns = {c: urls[c].tolist() for c in ("id", "host", "path")} | {"rule": [r for r, _ in found], "verdict": [v for _, v in found]}
    return pd.DataFrame(columns, dtype=object)


def _bounds(rows: DataFrame, ranges: int) -> list[str]:
    """Sorted keys that cut a sample of 30 keys a range, chosen by a hash, into equal parts."""
    keys = sorted(r[0] for r in rows.select("key").orderBy(F.xxhash64("key")).limit(30 * ranges).collect())
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _parts_of(bounds: list[str]):
    @F.pandas_udf("int")
    def part(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(bounds, k) for k in keys])

    @F.pandas_udf("array<int>")
    def parts(prefixes: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect.bisect_right(bounds, p), bisect.bisect_right(bounds, p + _TOP) + 1)) for p in prefixes])

    return part, parts


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
               range_rows: int = 200_000) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every row of ``urls``; ``rules`` has host, path, verdict.

    A rule fits its host and all hosts below it if the path starts with the rule's path; of several the
    longest (host and path together; of equals the one with the shorter host) decides, and ``default``
    where none fits. Of rules with the same host and path the last by verdict counts; rules with a NULL
    are left out. NULL URLs and those without ``://`` have an empty host and path. Every row is judged by
    itself, repeated ones too; an empty table of either kind is fine. ``range_rows`` is the aim for the
    rows of one unit, which one task holds in memory: a range, of which there are 1024 at most, or a share of one.
    """
    kind = urls.schema[id_col].dataType.simpleString()
    rows = urls.select(F.col(id_col).cast("string").alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rows = rows.select(*(F.coalesce(c, F.lit("")).alias(c) if c != "id" else c for c in rows.columns))
    rows = rows.withColumn("key", _key(F.col("host"), F.col("path"), F.col("id")))
    n = urls.count()
    ranges = min(_RANGES, max(8, -(-n // range_rows)))
    shares = max(1, -(-n // (ranges * range_rows)))
    part, parts = _parts_of(_bounds(rows, ranges))
    prefix = F.concat(F.array_join(F.reverse(F.split("host", r"\.")), SEPARATOR), F.lit(SEPARATOR))
    dealt = rules.select("host", "path", "verdict").dropna().select("*", F.explode(parts(prefix)).alias("part"))
    dealt = dealt.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def judge(some: pd.DataFrame, open_rules: pd.DataFrame) -> pd.DataFrame:
        if not len(some):
            return pd.DataFrame()
        out = _sweep(some, open_rules.sort_values("verdict", kind="stable"))
        out["verdict"] = [default if v is None else v for v in out["verdict"]]
        return out

    rows = rows.withColumn("part", part("key")).withColumn("share", F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int"))
    return (rows.groupBy("part", "share").cogroup(dealt.groupBy("part", "share"))
            .applyInPandas(judge, "id string, host string, path string, rule string, verdict string")
            .select(F.col("id").cast(kind).alias(id_col), "host", "path", "rule", "verdict"))
