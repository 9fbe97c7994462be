"""Secrets in texts: certain patterns, and weak candidates that complementary parts confirm.

Certain patterns are reported wherever they occur. A user name, an address or a random-looking string
alone is no finding; a credential has several parts. So weak candidates are sought too and reported only
when a complementary part is within ``reach`` characters (the scope): an identifier or address needs a
secret, a weak secret an identifier or address. This is an interval join within the document: the intervals of each
side are sorted and disjoint, so the nearest on either side is found by bisection and no pairs are formed.

A URL is taken apart: its user is a weak identifier (a weak secret if it looks random and has no password), its password a weak secret
whatever it looks like, a value of its query or fragment a weak secret if it looks random, and the rest, from host to path,
the endpoint. Parts of one URL are always in each other's scope; others measure their distance from the whole URL.

Defined results: a null text is empty and has no span; a null ``doc_id`` is kept as null; each repeated row gets its
spans; an empty table gives no row; other columns are not read. Each pattern passes a text once, so time
is linear in its length; a weak candidate that overlaps a certain one is dropped.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendframe.llm.common import as_docs, map_texts

Span = tuple[str, int, int]

#: Kinds in the order in which spans with the same start are listed; the first three are certain.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ID = re.compile(
    r"""(?:access_?key_?id|client_?id|account_?id|user_?name|user_?id|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}""",
    re.A | re.I,
)
_ID_WORDS = ("keyid", "key_id", "clientid", "client_id", "accountid", "account_id", "user", "login")
_ENDPOINT = re.compile(r"""(?:https?|ftp|amqps?|redis|mysql|postgres(?:ql)?|mongodb|s3)://[^\s"'<>]{4,}""", re.A | re.I)
_USER_INFO = re.compile(r"://([^\s/?#@:]*)(?::([^\s/?#]*))?@")
_PART = re.compile(r"[^&#;]+")
_WEAK_SECRET = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def _random_looking(s: str) -> bool:
    classes = sum(bool(re.search(c, s)) for c in ("[a-z]", "[A-Z]", "[0-9]"))
    return classes >= 2 and any(c.isdigit() for c in s) and _entropy(s) >= 3.0


def certain(text: str, lower: str) -> list[Span]:
    """Matches of the certain patterns: leftmost, not overlapping within a kind, failing ones dropped."""
    out: list[Span] = []
    if any(w in lower for w in _ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def _clear_of(taken: list[Span], spans: list[Span]) -> list[Span]:
    """Those of ``spans`` that overlap none of ``taken``."""
    merged: list[list[int]] = []
    for _, s, e in sorted(taken, key=lambda x: x[1]):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    ends = [e for _, e in merged]
    out = []
    for span in spans:
        k = bisect_left(ends, span[1] + 1)
        if k == len(merged) or merged[k][0] >= span[2]:
            out.append(span)
    return out


def _url_parts(text: str, start: int, end: int) -> list[Span]:
    """The endpoint of a URL and its weak identifier and secrets."""
    info = _USER_INFO.match(text, text.index("://", start), end)
    host = info.end() if info else start
    path_end = next((k for k in range(host, end) if text[k] in "?#"), end)
    out: list[Span] = []
    if info and info[2]:
        out.append(("weak_secret", *info.span(2)))
    if info and info[1]:
        out.append(("weak_id" if info[2] or not _has_secret(info[1]) else "weak_secret", *info.span(1)))
    for part in _PART.finditer(text, min(path_end + 1, end), end):
        value = text.find("=", *part.span()) + 1
        if value and _has_secret(unquote(text[value : part.end()])):
            out.append(("weak_secret", value, part.end()))
    return [*out, ("endpoint", host, path_end)] if path_end > host else out


def _has_secret(s: str) -> bool:
    return any(_random_looking(m[0]) for m in _WEAK_SECRET.finditer(s))


def _near(spans: list[Span], others: list[Span], reach: int) -> list[Span]:
    """Those of ``spans`` with one of ``others`` at most ``reach`` characters away."""
    others = sorted(others, key=lambda x: x[1])
    starts, ends, latest = [s for _, s, _ in others], [], 0
    for _, _, e in others:
        latest = max(latest, e)
        ends.append(latest)
    out = []
    for span in spans:
        k = bisect_left(starts, span[1])
        if (k and span[1] - ends[k - 1] <= reach) or (k < len(starts) and starts[k] - span[2] <= reach):
            out.append(span)
    return out


def linked(text: str, lower: str, base: list[Span], reach: int) -> list[Span]:
    """Weak candidates with a complementary part in reach."""
    urls: dict[Span, Span] = {}  # the whole URL that a part is of
    if "://" in text:
        for m in _ENDPOINT.finditer(text):
            urls.update((part, (part[0], *m.span())) for part in _url_parts(text, *m.span()))
    parts = _clear_of(base, list(urls))
    users = [x for x in parts if x[0] == "weak_id"]
    url_secrets = [x for x in parts if x[0] == "weak_secret"]
    endpoints = [x for x in parts if x[0] == "endpoint"]
    weak_ids: list[Span] = []
    if any(w in lower for w in _ID_WORDS):
        named = [("weak_id", *m.span()) for m in _ID.finditer(text)]
        info = [x for x in parts if x[0] != "endpoint" and text[x[1] - 1] in ":/"]  # user info is no name and value
        weak_ids = _clear_of(base + info, named)
        url_secrets = _clear_of(weak_ids, url_secrets)
    weak_ids += users
    identifying = weak_ids + endpoints + [x for x in base if x[0] == "access"]
    if not identifying:
        return []

    def near(spans: list[Span], others: list[Span]) -> list[Span]:
        kept = set(_near([urls.get(x, x) for x in spans], [urls.get(x, x) for x in others], reach))
        return [x for x in spans if urls.get(x, x) in kept]

    weak_secrets = [("weak_secret", *m.span()) for m in _WEAK_SECRET.finditer(text) if _random_looking(m[0])]
    whole = [("endpoint", s, e) for _, s, e in urls.values()]
    weak_secrets = near(_clear_of(base + weak_ids + whole, weak_secrets) + url_secrets, identifying)
    secrets = weak_secrets + [x for x in base if x[0] != "access"]
    return weak_secrets + near(weak_ids + endpoints, secrets)


def find_spans(text: str, reach: int = 200) -> list[Span]:
    lower = text.lower()
    base = certain(text, lower)
    return sorted(base + linked(text, lower, base, reach), key=lambda x: (x[1], KINDS.index(x[0])))


def scan(docs: DataFrame, reach: int = 200) -> DataFrame:
    """(doc_id, spans): spans (kind, start, end) in code points, end exclusive, by start and kind."""

    def run(rows: pa.RecordBatch, texts: list[str]) -> dict:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t, reach)] for t in texts]
        return {"doc_id": rows.column("doc_id"), "spans": spans}

    schema = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    return map_texts(as_docs(docs), ["doc_id", "text"], schema, run)


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def joined(kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans (of these kinds), comma-joined in their order."""
    spans = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
