"""Secret scan: patterns propose, structure confirms.

Three base kinds need no confirmation (``assign``, ``access``, ``hex``). Everything else is a candidate that counts only
if it decodes and its inside holds together: PEM blocks and bare base64 or hex runs must parse as a DER tree whose
nested lengths fill each other exactly, an OpenSSH key by its magic and length-prefixed fields, a signed token by
a JSON header naming its algorithm and a JSON payload, basic credentials by a printable ``user:password``. PEM blocks
encrypted under header lines hold no tree: they must name a cipher, and its blocks must fill the body. Base64 may use either
alphabet and may be wrapped over lines; a wrapped key ends where its own length says, at the end of a line.

A numpy pass over a batch's bytes picks the texts that can hold a match at all (a long run of key characters, or ``:``
or ``=``); only those are scanned, whole. Null and empty texts have no spans. Every row is kept, repeated ids included.
Overlapping spans of different kinds are all reported.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm import text as tx
from tradewind.llm.frames import keyed_texts, map_batches, rewrite_batches

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "der", "derhex", "jwt", "basic")
ORDER = {kind: k for k, kind in enumerate(KINDS)}

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}(?![0-9A-Fa-f])")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]++|-(?!----))++)-----END \1-----")
LINE_END = re.compile(r"\r\n|\n|\r|\\r\\n|\\n|\\r")
CIPHER = re.compile(r"([A-Z0-9-]+),((?:[0-9A-Fa-f]{2})+)")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40,}={0,2}")
URL_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9_-]{40,}={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:[ \t]*+(?:\r\n|\n|\r|\\r\\n|\\n)[ \t]*+[A-Za-z0-9+/_-]++)++")
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
BASIC = re.compile(r"\b[Bb]asic\x20+([A-Za-z0-9+/]{8,}={0,2})")
MIN_GROUP, MIN_ACCESS, MIN_HEX = 6, 20, 24
MAX_DEPTH = 16

KEY_BYTES = tx.lookup(lambda b: chr(b).isalnum() and b < 0x80 or chr(b) in "+/_.=-")
SIGN_BYTES = tx.lookup(lambda b: chr(b) in ":=")

SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def decode64(run: str) -> bytes | None:
    """Bytes of a base64 run in either alphabet, padding optional."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_children(data: bytes, lo: int, hi: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill ``data[lo:hi]`` exactly, or None."""
    out = []
    while lo < hi:
        if hi - lo < 2:
            return None
        tag, size, lo = data[lo], data[lo + 1], lo + 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or lo + width > hi or data[lo] == 0:
                return None
            size, lo = int.from_bytes(data[lo:lo + width], "big"), lo + width
            if size < 0x80:
                return None
        if lo + size > hi:
            return None
        out.append((tag, lo, lo + size))
        lo += size
    return out


def well_nested(data: bytes, lo: int, hi: int, depth: int = 0) -> bool:
    children = der_children(data, lo, hi)
    if children is None or depth > MAX_DEPTH:
        return False
    return all(well_nested(data, a, b, depth + 1) for tag, a, b in children if tag & 0x20)


def is_der_key(data: bytes | None) -> bool:
    """A DER sequence nested to the last byte: a small version number first, as in every plain private key form, or an
    encrypted key, an algorithm with its parameters and then the ciphertext."""
    if not data or data[0] != 0x30:
        return False
    top = der_children(data, 0, len(data))
    if not top or len(top) != 1 or not well_nested(data, 0, len(data)):
        return False
    inner = der_children(data, top[0][1], top[0][2]) or []
    if len(inner) == 2 and inner[0][0] == 0x30 and inner[1][0] == 0x04:
        algorithm = der_children(data, inner[0][1], inner[0][2]) or []
        # a digest has the same form, but no sequence of parameters
        return [tag for tag, _, _ in algorithm] == [0x06, 0x30] and inner[1][2] > inner[1][1]
    if len(inner) < 2 or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    return data[inner[0][1]] <= 3 and any(tag in (0x02, 0x04) for tag, _, _ in inner[1:])


def is_openssh_key(data: bytes | None) -> bool:
    """The magic, then length-prefixed cipher, key derivation and its options, all inside the data."""
    magic = b"openssh-key-v1\0"
    if not data or not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at:at + 4], "big") <= 16


def is_key(data: bytes | None) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def is_pem_key(body: str) -> bool:
    """A key between the marks of a PEM block, below header lines or not."""
    lines = [line.strip() for line in LINE_END.split(body.strip())]
    headers = [k for k, line in enumerate(lines) if ":" in line]
    if not headers:
        return is_key(decode64("".join("".join(lines).split())))
    # a header may go on over lines; an empty line ends them all, if there is one
    first = headers[-1] + 1
    ends = {first, next((k for k in range(first, len(lines)) if not lines[k]), first)}
    for end in ends:
        data = decode64("".join("".join(lines[end:]).split()))
        if is_key(data):
            return True
        head = "".join("".join(lines[:end]).split())
        cipher = CIPHER.search(head, head.find("DEK-Info:") + len("DEK-Info:")) if "DEK-Info:" in head else None
        if data and cipher and "Proc-Type:4,ENCRYPTED" in head:
            block = len(cipher[2]) // 2 if cipher[1].endswith(("-CBC", "-ECB")) else 1
            if len(data) % block == 0:
                return True
    return False


def key_size(head: bytes, data) -> int | None:
    """Bytes of the key that opens with ``head``, by its own length fields; ``data(n)`` has the first n bytes, if there are any."""
    if head[:1] == b"\x30":
        size, at = head[1], 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4:
                return None
            size, at = int.from_bytes(head[2:2 + width], "big"), 2 + width
        # a version number or an algorithm comes first
        return at + size if head[at] in (0x02, 0x30) else None
    if not b"openssh-key-v1\0".startswith(head):
        return None
    whole = data(None)
    if not is_openssh_key(whole):
        return None
    at = 15
    for field in range(3):
        at += 4 + int.from_bytes(whole[at:at + 4], "big")
    at, keys = at + 4, int.from_bytes(whole[at:at + 4], "big")
    for _ in range(keys + 1):  # the public keys and the private part
        at += 4 + int.from_bytes(whole[at:at + 4], "big")
    return at if at <= len(whole) else None


def wrapped_keys(text: str) -> list[tuple[int, int]]:
    """(start, end) of base64 keys that go over several lines."""
    out = []
    for m in WRAPPED.finditer(text):
        # a line end may be written as \\n, whose letter is no part of the next line
        pieces, at = [], m.start()
        while at < m.end():
            line = LINE.match(text, at)
            pieces.append(line.span())
            at = line.end()
            while at < m.end() and not (gap := LINE_END.match(text, at)):
                at += 1
            if at < m.end():
                at = gap.end()
                while at < m.end() and text[at] in " \t":
                    at += 1
        run = "".join(text[a:b] for a, b in pieces)
        ends = np.cumsum([b - a for a, b in pieces]).tolist()  # of the lines, in characters of the run
        k = 0
        while k < len(pieces):
            lo = ends[k - 1] if k else 0
            last = None
            if run.startswith(("M", "b3BlbnNzaC1r"), lo) and len(run) - lo >= 40:
                head = decode64(run[lo:lo + 12])
                size = key_size(head, lambda n: decode64(run[lo:lo + (len(run) - lo) // 4 * 4 + 4])) if head else None
                chars = -(-size * 8 // 6) if size else 0
                hi = lo + chars
                if size and hi <= len(run) and chars >= 40:
                    last = int(np.searchsorted(ends, hi))
                    # one line alone is the business of the other patterns
                    if ends[last] != hi or last == k or not is_key(decode64(run[lo:hi])):
                        last = None
            if last is None:
                k += 1
                continue
            end = pieces[last][1]
            for _ in range(-chars % 4):
                end += text[end:end + 1] == "="
            out.append((pieces[k][0], end))
            k = last + 1
    return out


def json_object(run: str) -> dict | None:
    data = decode64(run)
    try:
        value = json.loads(data) if data and data[:1] == b"{" else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    head = json_object(header)
    if not head or not isinstance(head.get("alg"), str):
        return False
    if head["alg"].lower() != "none" and not signature or decode64(signature) is None:
        return False
    return json_object(payload) is not None


def is_login(run: str) -> bool:
    data = decode64(run)
    return bool(data) and b":" in data[1:-1] and all(0x20 <= b < 0x7F for b in data)


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_GROUP]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            if is_pem_key(m[2]):
                found.append(("pem", *m.span()))
    keys = wrapped_keys(text)
    whole = tuple(keys)
    for m in {m.span(): m for form in (BASE64, URL_BASE64) for m in form.finditer(text)}.values():
        if is_key(decode64(m[0])) and not any(a <= m.start() and m.end() <= b for a, b in whole):
            keys.append(m.span())
    found += [("der", *span) for span in keys]
    for m in ANY_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and m[0].startswith("30") and is_der_key(bytes.fromhex(m[0])):
            found.append(("derhex", *m.span()))
    if "." in text:
        found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(*m.groups())]
    if "asic " in text:
        found += [("basic", *m.span()) for m in BASIC.finditer(text) if is_login(m[1])]
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def may_match(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row: a run of key characters as long as the shortest access key, or a sign that an assignment needs."""
    starts, ends = tx.runs(KEY_BYTES[data], offsets)
    hits = np.concatenate([starts[ends - starts >= MIN_ACCESS], np.flatnonzero(SIGN_BYTES[data])])
    flags = np.zeros(len(offsets) - 1, bool)
    flags[tx.row_of(hits, offsets)] = True
    if len(data):  # basic credentials and the lines of a PEM block may be shorter than any key
        raw = data.tobytes()
        flags[tx.row_of(np.array([m.start() for m in re.finditer(rb"asic |PRIVATE KEY-----", raw)], np.int64), offsets)] = True
    return flags


def scan_column(column: pa.Array):
    """Spans of every row of a column of texts."""
    for lo, hi, data, offsets in tx.parts(column):
        flags = may_match(data, offsets)
        for row in range(hi - lo):
            yield find_spans(data[offsets[row]:offsets[row + 1]].tobytes().decode("utf-8", "replace")) if flags[row] else []


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; spans are sorted by start, then kind, in code points, end exclusive."""

    def scan(batch):
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in found] for found in scan_column(batch.column(1))]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return map_batches(keyed_texts(df, id_col, text_col), scan, SCHEMA)


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def base_digest(spans) -> str:
    return hashlib.sha256(joined(s for s in spans if s[0] in BASE_KINDS).encode()).hexdigest()


def redact(text: str, spans, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by a mark."""
    out, done = [], 0
    for _, a, b in spans:
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact_secrets(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by a mark; ``size_col``, if there is one, follows the new text of changed rows."""
    place = docs.columns.index(text_col)
    sized = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batch):
        texts = batch.column(place).cast(pa.string())
        changed = {k: redact(texts[k].as_py(), spans) for k, spans in enumerate(scan_column(texts)) if spans}
        columns = list(batch.columns)
        if changed:
            columns[place] = pa.array([changed.get(k, t) for k, t in enumerate(texts.to_pylist())], columns[place].type)
            if sized is not None:
                sizes = columns[sized].to_pylist()
                columns[sized] = pa.array([len(changed[k]) if k in changed else n for k, n in enumerate(sizes)], columns[sized].type)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return rewrite_batches(docs, run)
