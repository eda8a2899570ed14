"""URL filter: a broadcast trie over reversed host labels and path segments."""

import pandas as pd
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rules of one trie. A longer list is judged in several tries, one after the other, each
# keeping the longest match so far, so that no broadcast passes this bound.
TRIE_RULES = 200_000
# Keys beside labels and segments; those are strings, so none can be one of these.
RULE, PARTS, PATHS = 0, 1, 2


def _segments(path):
    """A path cut after each slash; the last segment may be unfinished."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


def build_trie(rules):
    """rules: (host, path, verdict). Labels from the right, then path segments.

    A rule whose path does not end in a slash also fits longer last segments; these ends
    are kept aside at their node under ``PARTS``.
    """
    root = {}
    for host, path, verdict in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(PATHS, {})
        segments = _segments(path)
        tail = segments.pop() if segments and not segments[-1].endswith("/") else None
        for segment in segments:
            node = node.setdefault(segment, {})
        key = (len(host), len(path))
        if tail is None:
            node[RULE] = (key, host + path, verdict)
        else:
            node.setdefault(PARTS, {})[tail] = (key, host + path, verdict)
    return root


def longest_match(trie, host, path):
    """The rule with the longest host, then the longest path, or None."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if PATHS not in node:
            continue
        at = node[PATHS]
        found = at.get(RULE)
        for segment in _segments(path):
            parts = at.get(PARTS)
            if parts:
                for end in range(1, len(segment) + 1):
                    found = parts.get(segment[:end], found)
            at = at.get(segment)
            if at is None:
                break
            found = at.get(RULE, found)
        best = found or best
    return best


def url_parts(url):
    """Host and path as expressions: after the first '://', host lower-cased in A-Z only."""
    start = F.instr(url, "://") + 3
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, start, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(pages, rules, url="url", default="allow", trie_rules=TRIE_RULES):
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    rules: (host, path, verdict) triples; of equal (host, path) the last counts. A rule
    fits its host and all subdomains when the path starts with the rule's path. The
    longest host wins, then the longest path, whether it allows or blocks. A null URL or one
    without '://' has an empty host and path; without a rule the verdict is ``default``.
    Rows are never dropped; columns of ``pages`` with the names added are replaced. No
    shuffle: the trie travels with the function, at most ``trie_rules`` rules at a time.
    """
    host, path = url_parts(F.col(url))
    judged = pages.withColumns({"host": host, "path": path, "rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    for start in range(0, len(rules), trie_rules):
        judged = _judge(judged, build_trie(rules[start : start + trie_rules]))
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _judge(judged, trie):
    trie = judged.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf("rule string, verdict string")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        top = trie.value
        found = [longest_match(top, h, p) or (None, None, None) for h, p in zip(host, path)]
        return pd.DataFrame({"rule": [x[1] for x in found], "verdict": [x[2] for x in found]})

    # a later trie's rule replaces an earlier one's when its host, then its path, is not shorter
    size = lambda rule: F.struct(F.length(F.substring_index(rule, "/", 1)), F.length(rule))
    own = "_match"
    while own in judged.columns:
        own += "_"
    new = F.col(f"{own}.rule")
    better = new.isNotNull() & (F.col("rule").isNull() | (size(new) >= size(F.col("rule"))))
    judged = judged.withColumn(own, match("host", "path"))
    return judged.withColumns(
        {c: F.when(better, F.col(f"{own}.{c}")).otherwise(F.col(c)) for c in ("rule", "verdict")}
    ).drop(own)
