"""Secrets in text: fixed patterns, and strings that zstandard cannot shorten.

Patterns find assignments to secret names, access keys and long hexadecimal strings.
Besides, every long token near a sensitive word is a candidate. Its novelty is what it
adds to the compressed size of the code around it, with a compressor that already holds
a dictionary of common identifiers: a name or path costs little, a random key costs
nearly all of its bytes. Candidates of high novelty are reported as kind ``novel``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns, the shortest match of each, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "novel")

#: A candidate has at least this many characters; what a shorter one adds tells little.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: What makes the place of a candidate sensitive, within CONTEXT characters before it.
SENSITIVE = re.compile(
    r"pass|pwd|secret|token|key|auth|bearer|credential|private|signature|session|cookie|salt", re.ASCII | re.IGNORECASE
)
CONTEXT, AROUND = 48, 256
#: Added bytes per character from which a candidate counts as incompressible.
NOVELTY = 0.7

IDENTIFIERS = """
access account action address admin api app application argument array auth authorization backend base64 body
boolean bucket buffer byte cache callback certificate char class client cloud code collection column commit config
configuration connection const content context controller cookie create credential current data database date
debug default delete deploy description device dict domain element email enable encoding endpoint entry env
environment error event exception export false field file filter float format function generate get github group
handler hash header host html http https id image implements import index info input instance int interface item
iterator java json key label length library license list load local log login long main manager map message method
model module name namespace network node null number object option order output package page param parent parser
password path payload permission plugin point policy port prefix private process profile project property protected
protocol provider proxy public query queue read record region register release remote repository request require
resource response result return role route row schema scope script search secret security select self send server
service session set settings signature size source stack state static status storage store stream string struct
style system table target task template test text thread time timeout timestamp title token total transaction true
type undefined update upload url user username utf8 uuid value variable vector version view void volume web widget
window worker write www xml yaml abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789
"""


class Scanner:
    """Finds spans in one text. ``identifiers`` primes the compressor."""

    def __init__(self, identifiers: str = IDENTIFIERS, novelty: float = NOVELTY):
        import zstandard

        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=6)
        self.compressor = zstandard.ZstdCompressor(dict_data=primed, write_checksum=False, write_content_size=False)
        self.novelty = novelty

    def base(self, text: str) -> list[tuple[int, int, str]]:
        """(start, position of the kind, end) of the pattern matches, in order."""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def novel(self, text: str, known: list[tuple[int, int, str]]) -> list[tuple[int, int, int]]:
        """Spans of incompressible candidates that touch no span in ``known``."""
        found = []
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            if any(s < end and start < e for s, _, e in known):
                continue
            if SENSITIVE.search(text, max(0, start - CONTEXT), start) and self.added(text, start, end, True) >= self.novelty:
                found.append((start, 3, end))
        return found

    def added(self, text: str, start: int, end: int, alone: bool = False) -> float:
        """Compressed bytes that the candidate adds to the text around it, per byte of its own.

        ``alone`` takes other places of the same candidate out of that text.
        """
        own = text[start:end]
        # Copies that the edge of the text around would cut are taken out too.
        more = len(own) if alone else 0
        before, after = text[max(0, start - AROUND - more) : start], text[end : end + AROUND + more]
        if alone:
            before, after = before.replace(own, " ")[-AROUND:], after.replace(own, " ")[:AROUND]
        around, own = (after + before).encode("utf-8", "replace"), own.encode()
        return (len(self.compressor.compress(around + own)) - len(self.compressor.compress(around))) / len(own)

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """The pattern matches, and these with the novel spans."""
        base = self.base(text)
        return base, sorted(base + self.novel(text, base))


def find_secrets(df: DataFrame, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``found``, an array of (kind, start, end) of each row's whole text.

    Positions are code points, the end is exclusive; spans are in order of start, then
    of KINDS, and different kinds may overlap. A null or empty text has no spans.
    Repeated rows are scanned one by one; other columns of ``df`` are not read.
    """
    rows, names = df.select(*keep, F.col(text).alias("__text")), list(keep)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t.as_py() or "")[1]]
                for t in batch.column(len(names))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(found, kind)], names=[*names, "found"]
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(scan, ", ".join([*kept, "found array<struct<kind string, start long, end long>>"]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
