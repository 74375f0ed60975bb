"""URL filters: host and path rules first, then a weighted vocabulary of terms.

The vocabulary is compiled once in a task into an Aho-Corasick automaton that finds all terms in one pass over a url.
A hit counts only between boundaries: the character before it and the one after it is no ASCII letter or digit. One
strict term rejects a url, and so do ``soft_limit`` distinct soft terms.

Defined results: a null url, or one without ``://``, has an empty host and path, so no rule fits it; its terms still
count (null: none). Repeated urls are judged each by itself. An empty table gives an empty table. Input columns are kept;
one with the name of a result column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import annotate

# The vocabulary. Strict terms name what is never wanted, soft terms are only telling together.
STRICT = (
    "porn", "xxx", "hentai", "camgirls", "escorts", "sexcam", "onlyfans-leak", "warez", "keygen", "torrentz",
    "casino-bonus", "buy-viagra", "payday-loans",
)
SOFT = (
    "sex", "adult", "nude", "dating", "casino", "poker", "betting", "jackpot", "slots", "pills", "viagra", "crack",
    "serial", "torrent", "free-download", "cheap", "replica", "coupon", "loan", "bitcoin",
)
SOFT_LIMIT = 2

FIELDS = "host string, path string, rule string, strict_hits int, soft_hits int, terms array<string>, verdict string"
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    found = _PARTS.search(url) if url else None
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


def rule_index(rules: Iterable[tuple[str, str]]) -> dict[str, list[tuple[str, str, str]]]:
    """Rules ``(verdict, host/path)`` by host, longest path first."""
    index: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        index.setdefault(host.translate(_UPPER), []).append((slash + path, rule, verdict))
    for entries in index.values():
        entries.sort(key=lambda e: -len(e[0]))
    return index


def longest_rule(host: str, path: str, index: dict) -> tuple[str, str] | None:
    """The longest rule whose host is ``host`` or a parent domain and whose path starts ``path``.

    Of two equally long rules the one with the longer host wins.
    """
    best = None
    while host:
        for prefix, rule, verdict in index.get(host, ()):
            if path.startswith(prefix):
                if best is None or len(rule) > len(best[0]):
                    best = (rule, verdict)
                break
        host = host.partition(".")[2]
    return best


def compile_terms(strict: Iterable[str], soft: Iterable[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for is_strict, terms in ((False, soft), (True, strict)):
        for term in terms:
            automaton.add_word(term.translate(_UPPER), (term.translate(_UPPER), is_strict))
    automaton.make_automaton()
    return automaton


def distinct_hits(url: str | None, automaton: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms that stand between boundaries in a url."""
    strict: set[str] = set()
    soft: set[str] = set()
    if url and len(automaton):
        url = url.translate(_UPPER)
        for end, (term, is_strict) in automaton.iter(url):
            begin = end - len(term) + 1
            if (begin == 0 or url[begin - 1] not in _ALNUM) and (end + 1 == len(url) or url[end + 1] not in _ALNUM):
                (strict if is_strict else soft).add(term)
    return strict, soft


def judge_urls(
    urls: DataFrame,
    rules: Iterable[tuple[str, str]] = (),
    strict: Iterable[str] = STRICT,
    soft: Iterable[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
    url: str = "url",
    prefix: str = "",
) -> DataFrame:
    """Adds host, path, rule, strict_hits, soft_hits, terms and verdict (``allow`` or ``block``) to every row."""
    rules, strict, soft = list(rules), list(strict), list(soft)

    def make():
        index, automaton = rule_index(rules), compile_terms(strict, soft)

        def judge(values):
            rows = []
            for value in values:
                host, path = split_url(value)
                fits = longest_rule(host, path, index)
                hard, mild = distinct_hits(value, automaton)
                verdict = fits[1] if fits else "block" if hard or len(mild) >= soft_limit else "allow"
                rows.append((host, path, fits and fits[0], len(hard), len(mild), sorted(hard | mild), verdict))
            return list(zip(*rows))

        return judge

    return annotate(urls, F.col(f"`{url}`").cast("string"), make, FIELDS, prefix)
