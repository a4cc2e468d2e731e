"""Secrets in texts, with multipart credentials linked by an interval join.

A first pass finds base matches, which are secrets whatever stands beside them, and weak parts:
identifiers, secret values and endpoints that are too common to report alone. Scopes are intervals
of the text: sections between blank lines, and innermost brace blocks. Parts are joined with the
scopes that contain them, by their places. A weak part is reported only where its scope also holds
its complement: an identifier and a secret, or a secret and an endpoint.

A text is scanned, joined and reported inside one task, so nothing is shuffled. Parts are sorted by
place, and a scope finds its own by two binary searches; scopes of one kind do not overlap, so a
part lies in two scopes at most and the join stays linear in the text.

Defined results: a null text is empty and has no spans; a null `doc_id` is kept as it is; repeated
rows are scanned each; an empty table gives no rows; other columns are ignored. Places are code
points, ends are exclusive. A weak part that overlaps a base match is not reported again.
"""

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import functions as F

from pagetide.llm.tables import texts

# The base patterns, in the order in which kinds of one place are listed.
BASE = {
    "assign": (
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    # Runs of one class: the lengths leave out exactly the runs that are too short.
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
LEAST_VALUE = 6

# Weak parts. Each name stands for itself, so a word inside a longer one is no name.
_ASSIGNED = r"""(?<![A-Za-z0-9])(?:{})["']?\x20{{0,8}}[:=]\x20{{0,8}}["']?({})"""
WEAK = {
    "identifier": _ASSIGNED.format(
        r"(?:access|client|account|consumer|app|user|login|key)[_-]?(?:id|name|identifier)"
        r"|(?:aws_)?access[_-]?key(?:[_-]?id)?|user|login",
        r"[A-Za-z0-9@._+-]{3,}",
    ),
    "secret": _ASSIGNED.format(
        r"pwd|pass|passphrase|credential|auth|bearer"
        r"|(?:private|signing|access|account|shared|storage|master)[_-]?key",
        r"[A-Za-z0-9+/_.=~!@#$%^&*-]{8,}",
    ),
    "bare secret": r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])",
    "endpoint": (
        r"""[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\s"'<>{}]+"""
        r"""|(?<![A-Za-z0-9])(?:endpoint|host|hostname|server|base_?url)["']?\x20{0,8}[:=]\x20{0,8}"""
        r"""["']?[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,20}(?::[0-9]{1,5})?"""
    ),
}
KINDS = (*BASE, "identifier", "secret", "endpoint")
_BLANK_LINES = re.compile(r"\n(?:[^\S\n]*\n)+")
_BLOCK = re.compile(r"\{[^{}]*\}")

_flags = re.ASCII | re.IGNORECASE
_assign = re.compile(BASE["assign"], _flags)
_access, _hex = re.compile(BASE["access"]), re.compile(BASE["hex"])
_weak = {
    kind: re.compile(pattern, re.ASCII if kind == "bare secret" else _flags)
    for kind, pattern in WEAK.items()
}
# No credential is complete without an assignment, an address or an access identifier.
_HINT = re.compile("[:=]|AKIA")


def base_spans(text):
    """(start, kind, end) of base matches; a match whose value is too short is used up."""
    found = [
        (match.start(), 0, match.end())
        for match in _assign.finditer(text)
        if match.end(2) - match.start(2) >= LEAST_VALUE
    ]
    found += [(match.start(), 1, match.end()) for match in _access.finditer(text)]
    found += [(match.start(), 2, match.end()) for match in _hex.finditer(text)]
    return found


def _mixed(value):
    """Letters of both cases and digits, as keys have and words and numbers do not."""
    return (
        any("a" <= c <= "z" for c in value)
        and any("A" <= c <= "Z" for c in value)
        and any("0" <= c <= "9" for c in value)
    )


def _counts(kind, match):
    if kind == "bare secret":
        return _mixed(match[0])
    if kind == "secret":
        return any(c.isdigit() for c in match[1]) and any(c.isalpha() for c in match[1])
    return True


def weak_spans(text):
    """(start, kind, end) of weak parts."""
    return [
        (match.start(), KINDS.index(kind.split()[-1]), match.end())
        for kind, pattern in _weak.items()
        for match in pattern.finditer(text)
        if _counts(kind, match)
    ]


def scopes(text):
    """Intervals in which parts of one credential may stand together."""
    gaps = [match.span() for match in _BLANK_LINES.finditer(text)]
    sections = zip([0, *[end for _, end in gaps]], [*[start for start, _ in gaps], len(text)])
    return [*sections, *[match.span() for match in _BLOCK.finditer(text)]]


_IDENTIFIER, _SECRET, _ENDPOINT = map(KINDS.index, ("identifier", "secret", "endpoint"))
# Which part of a credential each kind is. A hex run may be a checksum: it is no more than a value.
_PARTS = {"assign": "secret", "access": "identifier", "hex": "value", "identifier": "identifier",
          "secret": "secret", "endpoint": "endpoint"}


def _complete(parts):
    if "identifier" in parts:
        return bool(parts & {"secret", "value"})
    return "endpoint" in parts and "secret" in parts


def linked(text, base):
    """Weak parts that stand in one scope with their complement, without those in base matches."""
    weak = weak_spans(text)
    if not weak:
        return []
    taken = sorted((start, end) for start, _, end in base)
    # Base matches of different kinds may overlap; the furthest end so far decides.
    ends, furthest = [], 0
    for _, end in taken:
        furthest = max(furthest, end)
        ends.append(furthest)
    starts = [start for start, _ in taken]

    def free(span):
        before = bisect_left(starts, span[2])
        return not before or ends[before - 1] <= span[0]

    weak = [span for span in weak if free(span)]
    parts = sorted(base + weak)
    places = [start for start, _, _ in parts]
    kept = set()
    for start, end in scopes(text):
        inside = parts[bisect_left(places, start) : bisect_left(places, end)]
        inside = [part for part in inside if part[2] <= end]
        if len(inside) > 1 and _complete({_PARTS[KINDS[kind]] for _, kind, _ in inside}):
            kept.update(inside)
    return [span for span in weak if span in kept]


def spans(text):
    """All spans of a text in order, as (start, place of the kind in `KINDS`, end)."""
    base = base_spans(text)
    return sorted(set(base + (linked(text, base) if _HINT.search(text) else [])))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scan(batches):
    for batch in batches:
        found = [
            [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in spans(text)]
            for text in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "spans"]
        )


def scan(docs):
    """`doc_id` and `spans`, the secrets of each text in order: kind, start and end."""
    return texts(docs).mapInArrow(
        _scan, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
    )


def is_base(span):
    return span["kind"].isin(*BASE)


def written(listed):
    """Spans as text: `kind:start:end`, joined by commas."""
    return F.array_join(
        F.transform(
            listed,
            lambda span: F.concat_ws(
                ":", span["kind"], span["start"].cast("string"), span["end"].cast("string")
            ),
        ),
        ",",
    )


def digests(docs):
    """Per document the number of base matches of each kind, their digest, and all spans as text."""

    def count(kind):
        own = F.filter("spans", lambda span: span["kind"] == kind)
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    return scan(docs).select(
        "doc_id",
        *map(count, BASE),
        F.sha2(written(F.filter("spans", is_base)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
