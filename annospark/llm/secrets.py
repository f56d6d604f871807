"""Secret scan: patterns find candidates, structure confirms them.

Three base patterns report every match of enough length. Beside them, runs of base64 letters, or of hex letters in either case, also such as line ends, quote marks,
escapes or colons interrupt, are searched for places where a key might begin, and parsed from there: nested DER lengths must fill their
parents, SSH key blobs must be made of length-prefixed fields with a known key type, OpenSSH private keys of all fields that the
format has, a signed token's header must be JSON that names an algorithm. Only what parses is reported, as long as it says it is.

Parsing decodes what it looks at and no more: the head of an element tells where the next one is, and any byte of a run can be decoded on its own. So a false beginning costs a few
letters, however long a key it claims, and keys may be of any length.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: Base patterns with the least length of group 1 (the value); all letters of `assign` in either case.
BASE = {
    "assign": (re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII), 6),
    "access": (re.compile(r"(AKIA[A-Z0-9]+)"), 20),
    "hex": (re.compile(r"([0-9a-f]+)"), 24),
}
KINDS = [*BASE, "pem", "der", "ssh", "jwt"]
_HINTS = ("passw", "secret", "token", "key")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
_HEX = re.compile(r"[0-9A-Fa-f]{24,}")
#: White space as text holds it when it is quoted, in JSON or source code, once or more: \n, \r, \t, \u000a, \u000d.
_ESCAPED = r"\\+(?:[nrt]|u000[adAD])"
_PEM = re.compile(rf"-----BEGIN ([A-Z0-9 ]++)-----((?:[A-Za-z0-9+/=\s>|]++|{_ESCAPED}|\\+/)*+)-----END \1-----")
_QUOTING = re.compile(rf"{_ESCAPED}|[\s>|]|\\+(?=/)")
#: Between the lines of an interrupted run: line ends, plain or escaped, with indentation and marks of quoted lines.
_BREAK = rf"(?:(?:\r?\n|{_ESCAPED})(?:[ \t>|]|{_ESCAPED})*+)"
_WRAPPED64 = re.compile(rf"(?<![A-Za-z0-9+/\\])[A-Za-z0-9+/]++(?:{_BREAK}[A-Za-z0-9+/]++)++")
#: Hex letters in pairs that colons, blanks, line ends or backslash-x part.
_WRAPPED16 = re.compile(rf"(?<![0-9A-WYZa-wyz])[0-9A-Fa-f]{{2,}}+(?:(?:[: ]{_BREAK}?|,? ?(?:\\+|0)x|{_BREAK})[0-9A-Fa-f]{{2,}}+)++")
_LETTERS = {64: re.compile(r"[A-Za-z0-9+/]+"), 16: re.compile(r"[0-9A-Fa-f]{2,}")}
_GLUE = {64: re.compile(_BREAK), 16: re.compile(rf"[: ]{_BREAK}?|,? ?(?:\\+|0)x|{_BREAK}")}
#: Segments that points join; they begin at the first letter of a run, so that the search stays linear.
_SEGMENTS = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+)++")
#: Where a key might begin: base64 of a SEQUENCE with its length, of a length before "ssh-" or "ecdsa-", of "openssh-key-v1"; hex of the same.
_KEY64 = re.compile(r"(?=M[A-I][A-Za-z0-9+/_-]{22}|AAAA[BCE][23]|b3BlbnNzaC1rZXktdjEA)")
_KEY16 = re.compile(r"(?=30(?:[0-7]|8[1-4])|000000[01][37b]7373682d|000000136563647361|6f70656e7373682d6b65792d763100)", re.IGNORECASE)
#: DER tags that hold other elements: SEQUENCE, SET and the context-specific constructed ones.
_HOLDERS = {0x30, 0x31, *range(0xA0, 0xA4)}
#: DER tags that key encodings use for values.
_VALUES = {0x01, 0x02, 0x03, 0x04, 0x05, 0x06, 0x0C, 0x13, 0x80, 0x81}


class Run:
    """The bytes that a run of letters stands for, from the letter `at` on; each part is decoded when it is asked for."""

    def __init__(self, letters: str, at: int, end: int, base: int):
        self.letters, self.at, self.base = letters, at, base
        self.size = (end - at) * (6 if base == 64 else 4) // 8

    def part(self, start: int, end: int) -> bytes:
        """Bytes start to end, fewer where the run ends."""
        end = min(end, self.size)
        if start >= end:
            return b""
        if self.base == 16:
            return bytes.fromhex(self.letters[self.at + 2 * start : self.at + 2 * end])
        first = start // 3
        letters = self.letters[self.at + 4 * first : self.at + -(-end * 4 // 3)].replace("-", "+").replace("_", "/")
        return base64.b64decode(letters + "=" * (-len(letters) % 4))[start - 3 * first : end - 3 * first]


class Plain:
    """Bytes that are decoded already."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def part(self, start: int, end: int) -> bytes:
        return self.data[start:end]


def _element(run: Run | Plain, at: int) -> tuple[int, int, int] | None:
    """Tag, first byte of the content and end of the DER element at a place; None if it has no definite length of up to four bytes."""
    head = run.part(at, at + 6)
    if len(head) < 2 or head[1] == 0x80 or head[1] > 0x84:
        return None
    if head[1] < 0x80:
        return head[0], at + 2, at + 2 + head[1]
    k = head[1] - 0x80
    return (head[0], at + 2 + k, at + 2 + k + int.from_bytes(head[2 : 2 + k], "big")) if len(head) >= 2 + k else None


def _der_end(run: Run | Plain) -> int:
    """Where the DER key at the start ends, 0 if there is none: a SEQUENCE that begins with an INTEGER or SEQUENCE and whose nested lengths add up exactly."""
    outer = _element(run, 0)
    if outer is None or outer[0] != 0x30 or not 16 <= outer[2] <= run.size or run.part(outer[1], outer[1] + 1) not in (b"\x02", b"\x30"):
        return 0
    at, open_ends = outer[1], [outer[2]]
    while open_ends:
        if at == open_ends[-1]:
            open_ends.pop()
            continue
        found = _element(run, at)
        if found is None or found[2] > open_ends[-1]:
            return 0
        tag, start, end = found
        if tag in _HOLDERS:
            if start == end:
                return 0
            open_ends.append(end)
            at = start
        elif tag in _VALUES:
            at = end
        else:
            return 0
    return outer[2]


def is_der_key(data: bytes) -> bool:
    """One outer SEQUENCE over all bytes, with nested lengths that add up and an INTEGER or SEQUENCE first."""
    return len(data) > 0 and _der_end(Plain(data)) == len(data)


def _field(run: Run | Plain, at: int) -> tuple[int, int] | None:
    """First byte and end of the length-prefixed field at a place."""
    size = run.part(at, at + 4)
    end = at + 4 + int.from_bytes(size, "big")
    return (at + 4, end) if len(size) == 4 and end <= run.size else None


#: Fields behind the key type of a public key.
_SSH_FIELDS = {b"ssh-rsa": 2, b"ssh-dss": 4, b"ssh-ed25519": 1, b"ecdsa-sha2-nistp256": 2, b"ecdsa-sha2-nistp384": 2, b"ecdsa-sha2-nistp521": 2}
_MAGIC = b"openssh-key-v1\0"


def _ssh_end(run: Run | Plain, at: int = 0) -> int:
    """Where the public key at a place ends, 0 if there is none: a known type and its fields, none empty."""
    kind = _field(run, at)
    fields = _SSH_FIELDS.get(run.part(*kind)) if kind and kind[1] - kind[0] < 32 else None
    if fields is None:
        return 0
    at = kind[1]
    for _ in range(fields):
        part = _field(run, at)
        if part is None or part[0] == part[1]:
            return 0
        at = part[1]
    return at


def _openssh_end(run: Run | Plain) -> int:
    """Where the private key at the start ends, 0 if there is none: cipher, derivation and its options, as many public keys as it says, and a
    private section of whole cipher blocks, in clear if no cipher is named."""
    at, fields = len(_MAGIC), []
    if run.part(0, at) != _MAGIC:
        return 0
    for _ in range(3):
        part = _field(run, at)
        if part is None:
            return 0
        fields.append(part)
        at = part[1]
    cipher, derivation = (run.part(a, min(b, a + 64)) for a, b in fields[:2])
    count, at = int.from_bytes(run.part(at, at + 4), "big"), at + 4
    if not (cipher.isascii() and cipher and (cipher == b"none") == (derivation == b"none") == (fields[2][0] == fields[2][1]) and count > 0):
        return 0
    for _ in range(count):  # a count that isn't true ends at the first field that is no key
        part = _field(run, at)
        if part is None or _ssh_end(run, part[0]) != part[1]:
            return 0
        at = part[1]
    private = _field(run, at)
    if private is None or private[0] == private[1] or (private[1] - private[0]) % 8:
        return 0
    check = run.part(private[0], private[0] + 8)
    return 0 if cipher == b"none" and check[:4] != check[4:] else private[1]


def is_ssh_key(data: bytes) -> bool:
    """A public key blob or an OpenSSH private key that fills all bytes."""
    return len(data) > 0 and len(data) in (_ssh_end(Plain(data)), _openssh_end(Plain(data)))


def key_at_start(run: Run | Plain) -> tuple[str, int] | None:
    """The kind of the key that a run begins with and its length in bytes."""
    if end := _der_end(run):
        return "der", end
    end = _ssh_end(run) or _openssh_end(run)
    return ("ssh", end) if end else None


def _key_kind(data: bytes) -> str | None:
    """The kind of the key that fills all of data."""
    found = key_at_start(Plain(data))
    return found[0] if found and found[1] == len(data) else None


def _keys_in(letters: str, start: int, end: int, base: int) -> Iterator[tuple[str, int, int]]:
    """Keys within letters[start:end], one after the other; `=` behind base64 not included."""
    at = start
    while m := (_KEY64 if base == 64 else _KEY16).search(letters, at, end):
        found = key_at_start(Run(letters, m.start(), end, base))
        at = m.start() + (-(-8 * found[1] // (6 if base == 64 else 4)) if found else 1)
        if found:
            yield found[0], m.start(), at


def _covers(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether any of the spans covers one from start to end."""
    spans = sorted(spans)
    starts, tops = [s for s, _ in spans], list(accumulate((e for _, e in spans), max))
    return lambda start, end: (i := bisect_right(starts, start)) > 0 and tops[i - 1] >= end


def _padded(text: str, end: int) -> int:
    """The end of base64 with its padding."""
    return next((i for i in range(end, end + 2) if text[i : i + 1] != "="), end + 2)


def _keys_over(text: str, base: int) -> Iterator[tuple[str, int, int]]:
    """Keys whose letters are interrupted, over the whole text: an interrupted run is searched as if it were one, and places are told by its pieces."""
    for m in (_WRAPPED64 if base == 64 else _WRAPPED16).finditer(text):
        plain = not ("\\" in m[0] if base == 64 else "\\u" in m[0])  # only letters of an escape could be taken for the run's
        if plain and not (_KEY64 if base == 64 else _KEY16).search("".join(_LETTERS[base].findall(m[0]))):
            continue
        starts, pieces, at = [], [], m.start()
        while at < m.end():
            piece = _LETTERS[base].match(text, at, m.end())
            starts.append(at)
            pieces.append(piece[0])
            at = piece.end()
            if at < m.end():
                at = _GLUE[base].match(text, at, m.end()).end()
        letters, ends = "".join(pieces), list(accumulate(map(len, pieces)))
        for kind, first, end in _keys_in(letters, 0, len(letters), base):
            i, k = bisect_right(ends, first), bisect_right(ends, end - 1)
            if i < k:  # else it is found in its own run
                stop = starts[k] + end - (ends[k] - len(pieces[k]))
                yield kind, starts[i] + first - (ends[i] - len(pieces[i])), _padded(text, stop) if base == 64 else stop


def decoded(run: str) -> bytes | None:
    """Bytes of a base64 or base64url run, or None."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(token: str) -> bool:
    """header.payload.signature whose header is a JSON object with a text `alg` and whose payload is a JSON object."""
    parts = token.split(".")
    try:
        header, payload = (json.loads(decoded(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict)


def _tokens_in(joined: str, start: int) -> Iterator[tuple[str, int, int]]:
    """Signed tokens among segments that points join: a header begins with its segment, or with the last `eyJ` in it."""
    parts = joined.split(".")
    at = 0
    for i, part in enumerate(parts[:-2]):
        for begin in {0, part.rfind("eyJ")} if "eyJ" in part else ():
            token = ".".join((part[begin:], parts[i + 1], parts[i + 2]))
            if part[begin:].startswith("eyJ") and parts[i + 1] and is_signed_token(token):
                yield "jwt", start + at + begin, start + at + begin + len(token)
        at += len(part) + 1


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings in code points, by start, then kind as listed in KINDS."""
    found = []
    runs = list(_RUN.finditer(text))
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [("assign", m.start(), m.end()) for m in BASE["assign"][0].finditer(text) if len(m[1]) >= BASE["assign"][1]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in BASE["access"][0].finditer(text) if len(m[1]) >= BASE["access"][1]]
    armoured: list[tuple[int, int]] = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            data = decoded(_QUOTING.sub("", m[2]))
            if data and _key_kind(data):
                armoured.append((m.start(), m.end()))
    keys: list[tuple[str, int, int]] = []
    for r in runs:  # a maximal hex run of enough letters lies within such a run, wherever that begins
        for m in BASE["hex"][0].finditer(text, r.start(), r.end()):
            if len(m[1]) >= BASE["hex"][1]:
                found.append(("hex", m.start(), m.end()))
        keys += [(kind, a, _padded(text, b)) for kind, a, b in _keys_in(text, r.start(), r.start() + len(r[0].rstrip("=")), 64)]
        for m in _HEX.finditer(text, r.start(), r.end()):
            keys += _keys_in(text, m.start(), m.end(), 16)
    over = [*_keys_over(text, 64), *_keys_over(text, 16)]
    # What lies within a longer key, as a part of it that parses on its own, is that key.
    inside = _covers([(s, e) for _, s, e in over])
    keys = [k for k in keys if not inside(*k[1:])] + over
    # A key within armour is reported as that.
    armour = _covers(armoured)
    found += [("pem", *a) for a in armoured] + [k for k in keys if not armour(*k[1:])]
    if "eyJ" in text:
        for m in _SEGMENTS.finditer(text):
            found += _tokens_in(m[0], m.start())
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t.as_py() or "")] for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, SPANS)], names=["doc_id", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, spans): spans is an array of (kind, start, end), code points, end exclusive, by start then kind.

    A row for each input row, repeated ones included. Null and empty texts have no spans; other columns are ignored;
    an empty table gives an empty table. A text is scanned whole in the task that reads it; nothing is shuffled.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(_scan), "doc_id long, spans array<struct<kind string, start long, end long>>")


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with every found span replaced by `mark` (overlapping spans by one mark). Null stays null."""
    at = docs.schema.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                if t:
                    parts, done = [], 0
                    for _, s, e in spans_of(t):
                        if s >= done:
                            parts += [t[done:s], mark]
                        done = max(done, e)
                    t = "".join([*parts, t[done:]])
                out.append(t)
            yield b.set_column(at, "text", pa.array(out, pa.string()))

    return docs.mapInArrow(tidy(run), docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, sha-256 of their spans, and all spans as text: kind:start:end, comma-joined."""
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
