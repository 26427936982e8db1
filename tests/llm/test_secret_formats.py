"""Token formats with an embedded check: valid ones are found, one changed character is not; base kinds by brute force."""

import base64
import hashlib
import re

import pyarrow.parquet as pq
import pytest

from lakegauge.llm import secrets

BECH, B58 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def bech32(name, raw):
    """Encoder that finds the checksum by polynomial division."""
    gen = [29, 22, 20, 21, 29, 18]                          # coefficients of the degree-6 generator over GF(32)
    bits = "".join(f"{b:08b}" for b in raw)
    data = [int(bits[i:i + 5].ljust(5, "0"), 2) for i in range(0, len(bits), 5)]

    def times(a, b):
        out = 0
        for i in range(5):
            out ^= (a << i) * (b >> i & 1)
        for i in range(8, 4, -1):
            out ^= (0b101001 << i - 5) * (out >> i & 1)
        return out

    line = [1] + [ord(c) >> 5 for c in name] + [0] + [ord(c) & 31 for c in name] + data + [0] * 6
    for i in range(len(line) - 6):
        lead = line[i]
        for j, g in enumerate(gen):
            line[i + 1 + j] ^= times(lead, g)
    end = line[-6:]
    end[-1] ^= 1
    return name + "1" + "".join(BECH[d] for d in data + end)


def base58(raw):
    n, out = int.from_bytes(raw + hashlib.sha256(hashlib.sha256(raw).digest()).digest()[:4], "big"), ""
    while n:
        n, r = divmod(n, 58)
        out = B58[r] + out
    return out


def b64(raw):
    return base64.urlsafe_b64encode(raw).rstrip(b"=").decode()


KEY = hashlib.sha256(b"key").digest()
MACAROON = b"\x02\x01\x08pypi.org\x02\x90\x01" + b"i" * 144 + b"\x00\x00\x06\x20" + KEY
TOKENS = {
    "age_key": bech32("age-secret-key-", KEY).upper(), "note_key": bech32("nsec", KEY),
    "wallet_key": base58(bytes.fromhex("0488ade4") + bytes(9) + KEY + b"\0" + KEY),
    "mail_key": f"SG.{b64(KEY[:16])}.{b64(KEY)}", "index_token": "pypi-" + b64(MACAROON),
}


def kinds(text):
    return [k for _, _, k in secrets.scanner()(text) if k not in secrets.BASE]


def test_bech32_vectors():
    """Valid and invalid strings of the format's public description."""
    assert all(secrets._bech32_ok(t) for t in ("A12UEL5L", "abcdef1qpzry9x8gf2tvdw0s3jn54khce6mua7lmqqqxw"))
    assert not secrets._bech32_ok("A12UEL5Q")


@pytest.mark.parametrize("kind", TOKENS)
def test_embedded_checks(kind):
    token = TOKENS[kind]
    assert kinds(f"x {token}, y") == [kind], token
    if kind == "index_token":
        bad = "pypi-" + b64(MACAROON[:11] + b"\x03" + MACAROON[12:])
    elif kind == "mail_key":
        bad = token[:-1] + B58[B58.index(token[-1]) + 1]
    else:
        i = len(token) - 9
        bad = token[:i] + ("Q" if token[i] not in "Qq" else "P").lower()[0:1] + token[i + 1:]
        bad = bad.upper() if kind == "age_key" else bad
    assert kinds(f"x {bad}, y") == [], bad


def test_crafted_tokens_end():
    for t in ("pypi-Ag" + "A" * 300_000, "pypi-AgEI" + "A" * 50, "SG." + "-" * 22 + "." + "_" * 43, "nsec1" + "q" * 58, "xprv" + "1" * 107):
        kinds(t)


def test_base_kinds_by_brute_force():
    """Each base kind by one search over the whole text."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    texts += ["Api_Key = 'abcdefgh' tokenpassword:12345678 AKIA12 AKIA1234567890ABCD" + "0f" * 17, None, "secret: a secret=bbbbbbbb"]
    scan = secrets.scanner()
    forms = [("assign", r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32)]
    seen = 0
    for t in texts:
        want = sorted((m.start(), i, m.end()) for i, (_, p, ok) in enumerate(forms) for m in re.finditer(p, t or "") if ok(m))
        got = [(s, secrets.BASE.index(k), e) for s, e, k in scan(t or "") if k in secrets.BASE]
        assert got == want
        seen += len(want)
    assert seen > 5
