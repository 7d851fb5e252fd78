"""Secret scan with structural confirmation.

Besides the plain patterns, which are always reported, runs that look like
base64 or hex are decoded and reported only if their bytes have the structure
of a secret: a private key whose nested lengths add up exactly (PKCS#1, PKCS#8,
encrypted PKCS#8, SEC 1 or OpenSSH, bare or in PEM armour), or a signed token whose
header and payload are JSON objects and whose header names an algorithm. Base64
may be wrapped in lines of one width, follow other characters of its alphabet,
or hold PEM armour.

Every text is scanned whole, in the task that read it; nothing is shuffled.

Defined cases: null text is empty and has no spans; repeated rows get equal
results; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship

# The plain patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

KINDS = ["assign", "access", "hex", "key", "token"]      # the order among spans that start together
WORDS = ("passw", "secret", "token", "api")              # one of them is in every assignment
ENCODED_LEAST = 40                                       # characters of an encoded key or token
LINE = r"[A-Za-z0-9+/_-]"
BREAK = re.compile(r"[ \t]*\r?\n[ \t]*|(?:\\r)?\\n")
ENCODED = re.compile(rf"{LINE}{{{ENCODED_LEAST},}}={{0,2}}(?:(?:{BREAK.pattern}){LINE}+={{0,2}})*")      # a run and the lines after it
HEAD = re.compile("M[A-J]|b3BlbnNzaC1rZXktdjE")          # how base64 of a DER sequence or of an OpenSSH key begins
HEX_TAIL = re.compile("[0-9a-fA-F]+$")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=([eICD][A-Za-z0-9_-]{12,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*))")   # "{" or a blank
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s\\]+)-----END \1-----")

#: What base64 of the armour's begin holds, by the place of its first byte in a group of three.
PEM_HEADS = [base64.b64encode(bytes(k) + b"-----BEGIN ").decode()[x:y] for k, x, y in ((0, 0, 14), (1, 2, 16), (2, 3, 17))]

_HEX_RUN = bytes(104 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_ENCODED_RUN = bytes(
    104 if chr(i) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 32 for i in range(256))


def unbase64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not; None if it is not base64."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """``(tag, start, end)`` of the DER values that fill ``data[at:end]`` exactly; None if they do not."""
    found = []
    while at < end:
        if end - at < 2:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or end - at < n:
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
        if size > end - at:
            return None
        found.append((tag, at, at + size))
        at += size
    return found


def is_der_key(data: bytes) -> bool:
    """A private key in DER: the outer sequence spans all bytes and its members have a key's types."""
    outer = elements(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = elements(data, *outer[0][1:])
    if not parts:
        return False
    tags = [t for t, _, _ in parts]
    if tags[0] == 0x02 and parts[0][2] - parts[0][1] == 1 and data[parts[0][1]] in (0, 1):
        if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]):          # modulus, exponents, primes, coefficient
            return True
        if len(tags) >= 3 and tags[1:3] == [0x30, 0x04]:                 # version, algorithm, key
            inner = elements(data, *parts[1][1:])
            return bool(inner) and inner[0][0] == 0x06
        if len(tags) >= 2 and tags[1] == 0x04 and data[parts[0][1]] == 1:     # version, key, curve, point
            return 16 <= parts[1][2] - parts[1][1] <= 66 and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags == [0x30, 0x04]:                                             # encryption algorithm, encrypted key
        inner = elements(data, *parts[0][1:])
        return bool(inner) and inner[0][0] == 0x06 and parts[1][2] - parts[1][1] >= 16
    return False


def is_openssh_key(data: bytes) -> bool:
    """The container of OpenSSH private keys: all length-prefixed fields fill the bytes exactly."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field(at):
        if len(data) - at < 4:
            return None
        end = at + 4 + int.from_bytes(data[at:at + 4], "big")
        return end if end <= len(data) else None

    for _ in range(3):                       # cipher, key derivation, its options
        at = field(at)
        if at is None:
            return False
    if len(data) - at < 4:
        return False
    keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):                # public keys, then the private part
        at = field(at)
        if at is None:
            return False
    return at == len(data)


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_openssh_key(data))


def is_signed_token(header: str, payload: str) -> bool:
    """Whether both decode to JSON objects and the header names its algorithm."""
    try:
        head, body = (json.loads(unbase64(x) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def _key_from(lines: list[tuple[int, str]], k: int, at: int) -> tuple[int, int] | None:
    """``(line, end)`` where a key ends that begins at a place of the k-th line and whose lines have one width."""
    said = lines[k][1][at:]
    width, last = len(said), k
    head = unbase64(said[:12]) or b""
    if head[:1] == b"0" and len(head) > 5:      # a DER sequence tells its length
        n = head[1] & 0x7F if head[1] & 0x80 else 0
        size = 2 + n + (int.from_bytes(head[2:2 + n], "big") if n else head[1])
        want = (4 * size + 2) // 3
        if n > 4 or (want > len(said.rstrip("=")) and (k + 1 == len(lines) or len(lines[k + 1][1]) > width)):
            return None
        parts, have = [said], len(said.rstrip("="))
        while have < want and len(lines[last][1]) - (at if last == k else 0) == width and last + 1 < len(lines):
            last += 1
            if len(lines[last][1]) > width:
                return None
            parts.append(lines[last][1])
            have += len(lines[last][1].rstrip("="))
        ok = have == want and is_key(unbase64("".join(parts)))
        return (last, len(lines[last][1])) if ok else None
    while last + 1 < len(lines) and len(lines[last + 1][1]) == width:
        last += 1
    shorter = last + 1 < len(lines) and len(lines[last + 1][1]) < width
    for end in (last + 1, last) if shorter else (last,):
        if is_key(unbase64(said + "".join(x for _, x in lines[k + 1:end + 1]))):
            return end, len(lines[end][1])
    return None


def _armoured(lines: list[tuple[int, str]], k: int) -> tuple[int, int, int] | None:
    """``(start, line, end)`` of base64 from the k-th line on whose bytes hold a key in PEM armour."""
    last = k + 1
    while last < len(lines) and len(lines[last][1]) == len(lines[k + 1][1]):
        last += 1
    chosen = lines[k:last + 1]       # lines of one width and the one after them
    said = "".join(x for _, x in chosen)
    for phase in range(4):
        plain = said[phase:].split("=")[0]
        data = unbase64(plain[:len(plain) - (len(plain) % 4 == 1)])
        for m in ARMOUR.finditer((data or b"").decode("latin-1")):
            if not is_key(unbase64(re.sub(r"\s|\\[nrt]", "", m[2]))):
                continue
            start, end = phase + m.start() // 3 * 4, phase + (4 * m.end() + 2) // 3
            for n, (_, x) in enumerate(chosen):      # the line that holds the last character
                if end <= len(x):
                    rest = x[end:]
                    blank = not rest.strip("=") or not (unbase64(said[phase + m.end() // 3 * 4:][:len(rest) + 4]) or b"x")[m.end() % 3:].strip()
                    return start, k + n, len(x) if blank else end
                end -= len(x)
    return None


def encoded_keys(text: str):
    """Yields ``(start, end, lines)`` of every encoded key."""
    for run in ENCODED.finditer(text):
        lines, at = [], run.start()
        for m in BREAK.finditer(text, run.start(), run.end()):
            lines.append((at, text[at:m.start()]))
            at = m.end()
        lines.append((at, text[at:run.end()]))
        k = 0
        while k < len(lines):
            at, said = lines[k]
            found = None
            m = HEX_TAIL.search(said) if len(said) >= ENCODED_LEAST else None
            if m and len(m[0]) >= ENCODED_LEAST and len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
                found = m.start(), k, len(said)
            if not found and any(h in said for h in PEM_HEADS):
                found = _armoured(lines, k)
            if not found:
                for m in HEAD.finditer(said):
                    if (end := _key_from(lines, k, m.start())):
                        found = m.start(), *end
                        break
            if found:
                start, last, end = found
                yield at + start, lines[last][0] + end, last - k + 1
                k = last
            k += 1


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of all secrets, by start and then kind; positions are code points, the end exclusive."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    low, found = text.lower(), []
    # cheap searches first: most texts hold nothing that the patterns could match
    if any(w in low for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if b"h" * HEX_LEAST in raw.translate(_HEX_RUN):
        found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= HEX_LEAST]
    if "-----BEGIN " in text:
        found += [("key", *m.span()) for m in ARMOUR.finditer(text)
                  if is_key(unbase64(re.sub(r"\s|\\[nrt]", "", m[2])))]
    if "." in text:
        found += [("token", m.start(), m.end(3)) for m in TOKEN.finditer(text) if is_signed_token(m[1], m[2])]
    if b"h" * ENCODED_LEAST in raw.translate(_ENCODED_RUN):
        armour = [x for x in found if x[0] == "key"]
        # the lines between armour are no key of their own
        found += [("key", x, y) for x, y, n in encoded_keys(text) if n == 1 or not any(a <= x and y <= b for _, a, b in armour)]
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row of ``docs(doc_id, text)``."""
    def run(batches):
        import hashlib

        import pyarrow as pa

        for b in batches:
            rows = []
            for t in b.column(1):
                found = spans(t.as_py())
                said = [f"{k}:{x}:{y}" for k, x, y in found]
                base = [s for s, f in zip(said, found) if f[0] in KINDS[:3]]
                rows.append((*(sum(f[0] == k for f in found) for k in KINDS[:3]),
                             hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(said)))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
