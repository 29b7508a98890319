"""URL allow / block lists as one trie over reversed host labels and path segments.

The list is a parameter (not corpus data): its size is checked before it is broadcast.  Every URL walks
the trie once, so the cost per row does not depend on the number of entries.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (action, host, path); an entry fits its host and all subdomains if the URL's path starts with its path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: entries a broadcast trie may hold (about 300 bytes each)
MAX_RULES = 1_000_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or a URL without ``://``."""
    scheme, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[cut:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return rest[:cut].translate(_LOWER), path[:end]


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Nested dictionaries (plain data, to be broadcast).  A host label or path segment is a node: ``next`` by label or
    segment, ``paths`` the path trie of a host, ``ends`` what may follow the last complete segment: the
    unfinished segment of an entry ('' if it ends in a slash), with the entry, and ``lengths`` of those."""
    root: dict = {"next": {}}
    for action, host, path in rules:
        if action not in ("allow", "block") or not path.startswith("/"):
            raise ValueError(f"not an entry: {(action, host, path)}")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node["next"].setdefault(label, {"next": {}})
        node = node.setdefault("paths", {"next": {}})
        *segments, tail = path[1:].split("/")
        for segment in segments:
            node = node["next"].setdefault(segment, {"next": {}})
        entry = (len(host) + len(path), len(host), action == "block", host + path, action)
        ends = node.setdefault("ends", {})
        ends[tail] = max(entry, ends.get(tail, entry))
        node["lengths"] = sorted({len(t) for t in ends})
    return root


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, action) of the longest entry that fits; ties: the longer host, then block."""
    if not path.startswith("/"):
        return None
    segments, best, node = path[1:].split("/"), None, trie
    for label in reversed(host.split(".")):
        node = node["next"].get(label)
        if node is None:
            break
        at = node.get("paths")
        for i, segment in enumerate(segments):
            if at is None:
                break
            for n in at.get("lengths", ()):
                entry = at["ends"].get(segment[:n]) if n <= len(segment) else None
                if entry and (best is None or entry > best):
                    best = entry
            at = at["next"].get(segment) if i + 1 < len(segments) else None
    return best and best[3:]


def filter_urls(pages: DataFrame, rules=RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every row's URL: (id, host, path, rule, verdict).

    ``rule`` is the longest fitting entry (host and path), null if none fits; the verdict is then
    ``default``.  A null URL, or one without ``://``, has an empty host and path, so no rule.  Rows are
    judged one by one: repeated rows stay, an empty table gives an empty result, other columns are ignored.
    """
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} entries; a broadcast trie may hold {MAX_RULES}")
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        out = []
        for url in urls:
            host, path = split_url(url)
            rule, verdict = match(trie.value, host, path) or (None, default)
            out.append((host, path, rule, verdict))
        return pd.DataFrame(out, columns=["host", "path", "rule", "verdict"])

    return pages.select(F.col(id_col).alias(id_col), judge(F.col(url_col).cast("string")).alias("_j")).select(id_col, "_j.*")
