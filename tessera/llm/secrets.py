"""Secret scans: patterns, then structural confirmation of encoded candidates."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order of their kinds; the second number is the least length, of group 2 for assign.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a greedy run under 18 characters holds no longer one
HEX = re.compile(r"[0-9a-f]{16,}")  # likewise: whole runs, of 16 or more
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "token", "key")

JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
#: The first base64 characters of a DER private key (a sequence whose first element is a version, INTEGER 0 or 1), by the form of its length, and
#: OpenSSH's magic. A key may begin anywhere, also after a character of the alphabet.
KEY_START = re.compile(r"M(?:[A-H][AEIMQUYcgkosw048]CAQ[A-H]|I(?:[GH].AgE[AB]|[I-L]..[AQgw]IBA|[M-T]))|b3BlbnNzaC1rZXktdjEA")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]+")
#: What may part the lines of a key: line ends, also written as escapes, with indentation.
LINE_END = re.compile(r"[\x20\t]*(?:\r\n?|\n|(?:\\r)?\\n)[\x20\t]*")
PADDING = re.compile(r"={0,2}")
GOES_ON = re.compile(r"[A-Za-z0-9+]")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){16,}(?![0-9A-Fa-f])")

#: Object identifiers of key algorithms (RSA, EC, Ed25519, X25519, Ed448, X448, DSA, DH), DER contents, and what a key of each is: a
#: number is the length of its octet string.
KEY_OIDS = {
    bytes.fromhex("2a864886f70d010101"): "rsa",
    bytes.fromhex("2a8648ce3d0201"): "ec",
    bytes.fromhex("2b6570"): 32,
    bytes.fromhex("2b656e"): 32,
    bytes.fromhex("2b6571"): 57,
    bytes.fromhex("2b656f"): 56,
    bytes.fromhex("2a8648ce380401"): "number",
    bytes.fromhex("2a864886f70d010301"): "number",
}
#: Bytes of a private number on the curves in use.
EC_LENGTHS = (20, 24, 28, 30, 32, 36, 48, 64, 66)
#: Fixed value: the magic of OpenSSH private keys.
OPENSSH = b"openssh-key-v1\x00"
#: Names that begin an SSH wire-format key.
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")


def decode64(text: str) -> bytes | None:
    """The bytes of base64 in either alphabet, with or without padding and line ends; None if it is none."""
    body = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER element at ``at``, which must end by ``end`` and have the shortest form of its length."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill the span exactly, each nested one with its length checked; None if they do not."""
    out = []
    while at < end:
        if (x := der(data, at, end)) is None:
            return None
        out.append(x)
        at = x[2]
    return out


def is_rsa_key(data: bytes, at: int, end: int) -> bool:
    """PKCS #1: a sequence of a version and eight numbers, all positive; of version 1 the infos of further primes follow, of version 0 nothing."""
    top = der(data, at, end)
    if top is None or top[0] != 0x30 or top[2] != end or not (parts := children(data, top[1], end)):
        return False
    if len(parts) not in (9, 10) or any(p[0] != 0x02 or p[1] == p[2] for p in parts[:9]) or any(data[p[1]] >= 0x80 for p in parts[:9]):
        return False
    version = data[parts[0][1] : parts[0][2]]
    if len(parts) == 9:
        return version == b"\x00"
    more = parts[9][0] == 0x30 and children(data, parts[9][1], parts[9][2])
    return version == b"\x01" and bool(more) and all(p[0] == 0x30 and len(children(data, p[1], p[2]) or ()) == 3 for p in more)


def is_ec_key(data: bytes, at: int, end: int) -> bool:
    """SEC 1: a sequence of version 1, an octet string of a curve's length, and nothing but the curve and the public key after it."""
    top = der(data, at, end)
    if top is None or top[0] != 0x30 or top[2] != end or not (parts := children(data, top[1], end)):
        return False
    tags = [p[0] for p in parts]
    if tags[:2] != [0x02, 0x04] or tags[2:] not in ([], [0xA0], [0xA1], [0xA0, 0xA1]) or data[parts[0][1] : parts[0][2]] != b"\x01":
        return False
    return parts[1][2] - parts[1][1] in EC_LENGTHS and all(children(data, p[1], p[2]) for p in parts[2:])


def is_number(data: bytes, at: int, end: int) -> bool:
    """A positive INTEGER that fills the span: the private number of DSA and DH."""
    x = der(data, at, end)
    return x is not None and x[0] == 0x02 and x[2] == end and x[1] < end and data[x[1]] < 0x80 and any(data[x[1] : end])


def is_der_key(data: bytes) -> bool:
    """A private key in DER: PKCS #8, PKCS #1 or SEC 1, whose nested lengths all agree. Public keys are no secret.

    What PKCS #8 wraps is parsed in turn, by the algorithm that it names.
    """
    top = der(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = children(data, top[1], top[2])
    if not parts or parts[0][0] != 0x02:
        return False
    tags = [p[0] for p in parts]
    if tags[1:3] != [0x30, 0x04]:
        return is_rsa_key(data, 0, len(data)) or is_ec_key(data, 0, len(data))
    version = data[parts[0][1] : parts[0][2]]  # with version 1 the public key may follow
    if (version, tags[3:]) not in ((b"\x00", []), (b"\x00", [0xA0]), (b"\x01", [0x81]), (b"\x01", [0xA1]), (b"\x01", [0xA0, 0x81]), (b"\x01", [0xA0, 0xA1]), (b"\x01", [])):
        return False
    algorithm = children(data, parts[1][1], parts[1][2])
    if not algorithm or algorithm[0][0] != 0x06:
        return False
    kind = KEY_OIDS.get(data[algorithm[0][1] : algorithm[0][2]])
    a, z = parts[2][1:]
    if kind == "rsa":
        return is_rsa_key(data, a, z)
    if kind == "ec":
        return is_ec_key(data, a, z)
    if kind == "number":
        return is_number(data, a, z)
    inner = der(data, a, z) if kind else None  # the others: an octet string of the curve's length
    return inner is not None and inner[0] == 0x04 and inner[2] == z and inner[2] - inner[1] == kind


def ssh_end(data: bytes) -> int | None:
    """Where the OpenSSH private key at the start of ``data`` ends: its magic, then strings whose lengths lie within it; None if there is none."""
    if not data.startswith(OPENSSH):
        return None
    at = len(OPENSSH)
    for _ in range(3):  # cipher, key derivation and its options
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4 + n
        if at + 4 > len(data):
            return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 64:
        return None
    for k in range(keys):
        n = int.from_bytes(data[at : at + 4], "big")
        blob = data[at + 4 : at + 4 + n]
        name = blob[4 : 4 + int.from_bytes(blob[:4], "big")]
        if len(blob) != n or k == 0 and name not in SSH_NAMES:
            return None
        at += 4 + n
    end = at + 4 + int.from_bytes(data[at : at + 4], "big")  # the private part
    return end if at + 4 < end <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    return ssh_end(data) is not None


def is_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 16 and (is_der_key(data) or is_ssh_key(data))


def body(text: str, at: int, most: int) -> tuple[str, int]:
    """Up to ``most`` base64 characters from ``at`` on, over line ends, and where they end in the text."""
    parts, end = [], at
    while most and (m := BASE64.match(text, at, min(len(text), at + most))):
        parts.append(m[0])
        most -= len(m[0])
        end = m.end()
        if not (gap := LINE_END.match(text, end)):
            break
        at = gap.end()
    return "".join(parts), end


def key_end(text: str, at: int) -> int | None:
    """Where the base64 of the private key at ``at`` ends, padding included; None if no key begins there.

    The key's own lengths say how many characters belong to it, so its lines may have any length and its last one may be short.
    """
    if text[at] == "b":
        run = body(text, at, len(text))[0]
        if "-----" in run:
            run = run[: run.index("-----")]
        data = decode64(run[: len(run) // 4 * 4 + (len(run) % 4 if len(run) % 4 > 1 else 0)])
        size = data and ssh_end(data)
    else:
        head = decode64(body(text, at, 8)[0])
        top = der(head, 0, len(text)) if head and len(head) == 6 else None
        size = top and top[2]
    if not size:
        return None
    n = -(-size * 4 // 3)
    run, end = body(text, at, n)
    if len(run) < n or not is_key(decode64(run)):
        return None
    end = PADDING.match(text, end).end()
    return None if GOES_ON.match(text, end) else end


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """A JSON web signature: header and payload decode to JSON objects, the header names its algorithm and the signature is bytes."""
    try:
        head, body = (json.loads(decode64(x) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return head["alg"].lower() != "none" and bool(signature) and len(decode64(signature) or b"") >= 16


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, in code points."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the encoded candidates whose decoded structure proves a token or a private key."""
    out = [(*m.span(), "token") for m in JWT.finditer(text) if is_signed_token(*m.groups())]
    done = 0
    for m in KEY_START.finditer(text):
        if m.start() >= done and (end := key_end(text, m.start())):
            out.append((m.start(), end, "key"))
            done = end
    for m in HEX_RUN.finditer(text):
        if m[0][:2].lower() in ("30", "6f") and is_key(bytes.fromhex(m[0])):
            out.append((*m.span(), "key"))
    return out


def listed(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then kind in the order of KINDS, then end, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row of ``docs``; whole texts, no shuffle.

    Base matches are all reported. To these come signed tokens and private keys (PKCS #8, PKCS #1, SEC 1 in DER, OpenSSH) found by
    decoding base64 and hex candidates and checking their nested structure; candidates that don't decode to one are not
    reported. A null text counts as empty and has no spans. Rows are scanned one by one, so repeated rows stay repeated; an empty
    table gives an empty result; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, sums, spans = [], [], []
            for t in b.column(1).to_pylist():
                base = base_spans(t or "")
                counts.append([sum(s[2] == k for s in base) for k in KINDS[:3]])
                sums.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(base + confirmed_spans(t or "")))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *columns, pa.array(sums, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(of, schema)
