"""URL rules and a weighted URL vocabulary (operator 2).

Allow and block rules name a host and the beginning of a path; a rule fits its
host and all subdomains, and the longest fitting rule decides. Where none fits,
an Aho-Corasick automaton finds the vocabulary's terms in the lower-cased URL in
one pass. A term counts once, and only where no ASCII letter or digit touches
it. Terms that weigh the threshold are strict: one blocks. Lighter ones
are soft: several different ones block together.

Rules and vocabulary are small parameters that go to the tasks with the code;
there is no shuffle, and only the URL column is read.

Defined cases: a null URL or one without ``://`` has an empty host and path and is
fitted by no rule; its terms still count. Of rules of one length that both fit,
the one with the longer host decides, then a block before an allow. Repeated rows
are judged each; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

Rules = Iterable[tuple[str, str]]  # (allow or block, host/path)

# The default vocabulary: terms of at least THRESHOLD are strict.
THRESHOLD = 2
VOCABULARY = {
    "casino": 2, "escort": 2, "malware": 2, "phishing": 2, "porn": 2, "spam": 2, "spam-farm": 2, "viagra": 2, "warez": 2,
    "xxx": 2,
    "adult": 1, "bet": 1, "bonus": 1, "cheap": 1, "dating": 1, "download": 1, "farm": 1, "free": 1, "loan": 1, "pills": 1,
    "poker": 1, "replica": 1, "win": 1,
}

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = _END.search(rest)
    host = rest[: end.start()] if end else rest
    path = rest[len(host) :]
    end = _PATH_END.search(path)
    return host.translate(_LOWER), path[: end.start()] if end else path


class RuleBook:
    """Rules by host; a URL meets only those of its own host's suffixes."""

    def __init__(self, rules: Rules):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for action, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, action, rule))

    def fit(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest rule that fits."""
        best, best_rank = None, None
        suffix = host
        while True:
            for start, action, rule in self.by_host.get(suffix, ()):
                rank = (len(rule), len(suffix), action == "block")
                if path.startswith(start) and (best is None or rank > best_rank):
                    best, best_rank = (rule, action), rank
            if "." not in suffix:
                return best
            suffix = suffix.partition(".")[2]


def automaton(vocabulary: dict[str, int]) -> ahocorasick.Automaton | None:
    found = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        found.add_word(term, (term, weight))
    if not vocabulary:
        return None
    found.make_automaton()
    return found


def terms(url: str | None, words: ahocorasick.Automaton | None) -> dict[str, int]:
    """The different terms that stand alone in the URL, with their weights."""
    if not url or words is None:
        return {}
    lower, found = url.translate(_LOWER), {}
    for end, (term, weight) in words.iter(lower):
        start = end - len(term) + 1
        if (start == 0 or lower[start - 1] not in _WORD) and (end + 1 == len(lower) or lower[end + 1] not in _WORD):
            found[term] = weight
    return found


def judged(url: Column, rules: Rules, vocabulary: dict[str, int] = VOCABULARY, threshold: int = THRESHOLD) -> Column:
    """A struct of a URL column: host, path, rule, verdict, n_strict, n_soft."""
    rules, vocabulary = list(rules), dict(vocabulary)
    kind = T.StructType()
    for name in ("host", "path", "rule", "verdict"):
        kind = kind.add(name, T.StringType())
    kind = kind.add("n_strict", T.LongType()).add("n_soft", T.LongType())

    @F.pandas_udf(kind)
    def judge(urls: pd.Series) -> pd.DataFrame:
        book, words = RuleBook(rules), automaton(vocabulary)
        rows = []
        for value in urls:
            host, path = host_and_path(value)
            hits = terms(value, words)
            strict = sum(w >= threshold for w in hits.values())
            fit = book.fit(host, path) if host else None
            verdict = fit[1] if fit else "block" if sum(hits.values()) >= threshold else "allow"
            rows.append((host, path, fit[0] if fit else None, verdict, strict, len(hits) - strict))
        return pd.DataFrame(rows, columns=kind.names)

    return judge(url)
