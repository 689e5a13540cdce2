"""URL filters: allow and block rules in a trie over reversed host labels and
path segments.

A rule (host, path) fits its host and all subdomains, for urls whose path
starts with the rule's path (an empty rule path fits every path).  Of the
rules that fit a url the longest wins: most characters of host and path, then
the longer host; of equal rules block wins.  Where none fits, the verdict is
the caller's default.

The rules are configuration, handed over by the caller; at most ``MAX_RULES``
are taken, which bounds the broadcast trie.  Urls are judged where they are
read, without a shuffle.

Defined cases: a null url or one without :// has empty host and path and
fits no rule; empty tables give no rows; repeated rows are judged alike; the
columns added replace columns of the same name.
"""
from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
_LOWER = {c: c + 32 for c in range(65, 91)}


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host (A-Z lower-cased) and the path of a url."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(_LOWER), slash + path


class Trie:
    """Host labels from the top-level one on; below a host, path segments; a
    rule ends at a segment's node with the start of the next segment."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            paths = node.setdefault(None, {})  # no label is None
            if path:
                *segments, last = path[1:].split("/") if path[0] == "/" else [path]
                if path[0] != "/":
                    continue  # no url has such a path
                for s in segments:
                    paths = paths.setdefault(("dir", s), {})
                key = ("start", last)
                paths["longest"] = max(len(last), paths.get("longest", 0))
            else:
                key = "any"
            if key not in paths or verdict == "block":
                paths[key] = (len(host) + len(path), len(host), host + path, verdict)

    @staticmethod
    def _longest(node: dict, path: str):
        best = node.get("any")
        at = 1
        while path and node is not None:
            end = path.find("/", at)
            segment = path[at:] if end < 0 else path[at:end]
            for n in range(min(len(segment), node.get("longest", -1)) + 1):
                found = node.get(("start", segment[:n]))
                if found and (best is None or found > best):
                    best = found
            if end < 0:
                break
            node, at = node.get(("dir", segment)), end + 1
        return best

    def match(self, host: str, path: str):
        """(rule, verdict) of the longest rule that fits, or None."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                found = self._longest(node[None], path)
                if found and (best is None or found[:2] > best[:2]):
                    best = found
        return best and best[2:]


def judge_urls(df: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule (host and path of the rule that won, or
    null) and verdict.  rules: (allow or block, host, path)."""
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules are more than the broadcast bound of {MAX_RULES}")
    sent = df.sparkSession.sparkContext.broadcast(rules)
    held: dict = {}

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        if "trie" not in held:
            held["trie"] = Trie(sent.value)
        out = []
        for url in urls:
            host, path = host_and_path(url)
            rule, verdict = held["trie"].match(host, path) or (None, default)
            out.append((host, path, rule, verdict))
        return pd.DataFrame(out, columns=["host", "path", "rule", "verdict"], dtype=object)

    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict", "_judged")]
    judged = df.withColumn("_judged", judge(F.col(url_col).cast("string")))
    return judged.select(*kept, *[F.col(f"_judged.{c}").alias(c) for c in ("host", "path", "rule", "verdict")])
