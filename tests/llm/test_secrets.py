"""Secret scans: patterns against a plain reading, encodings built here."""

import base64
import hashlib
import json
import random
import re
import time

import pytest

from pagetables.llm import secrets


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


def number(n_bytes, rng):
    return der(0x02, b"\0" + bytes([0x80 | rng.randrange(128)]) + rng.randbytes(n_bytes - 1))


def rsa_key(rng, bits=1024):
    n = bits // 8
    small = der(0x02, b"\0"), der(0x02, b"\1\0\1")
    return der(0x30, small[0], number(n, rng), small[1], number(n, rng), *[number(n // 2, rng) for _ in range(5)])


def pkcs8(rng):
    algorithm = der(0x30, der(0x06, bytes.fromhex("2b6570")))
    return der(0x30, der(0x02, b"\0"), algorithm, der(0x04, der(0x04, rng.randbytes(32))))


def ec_key(rng):
    return der(0x30, der(0x02, b"\1"), der(0x04, rng.randbytes(32)), der(0xA0, der(0x06, bytes.fromhex("2a8648ce3d030107"))))


def encrypted(rng):
    algorithm = der(0x30, der(0x06, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(0x04, rng.randbytes(8))))
    return der(0x30, algorithm, der(0x04, rng.randbytes(64)))


def openssh(rng):
    def part(body):
        return len(body).to_bytes(4, "big") + body

    public = part(b"ssh-ed25519") + part(rng.randbytes(32))
    return secrets.OPENSSH + part(b"none") + part(b"none") + part(b"") + b"\0\0\0\1" + part(public) + part(rng.randbytes(136))


MAKERS = [rsa_key, pkcs8, ec_key, encrypted, openssh]


def armour(label, body):
    text = base64.b64encode(body).decode()
    lines = "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
    return f"-----BEGIN {label}PRIVATE KEY-----\n{lines}\n-----END {label}PRIVATE KEY-----"


def url64(body):
    return base64.urlsafe_b64encode(body).decode().rstrip("=")


def token(algorithm="HS256", size=32, payload=b'{"sub":"1"}'):
    return ".".join([url64(json.dumps({"alg": algorithm, "typ": "JWT"}).encode()), url64(payload), url64(b"x" * size)])


def found(text):
    return [(secrets.KINDS[k], text[b:e]) for b, k, e in sorted(secrets.confirmed_spans(text))]


@pytest.mark.parametrize("make", MAKERS)
def test_keys_are_confirmed_in_base64_hex_and_armour(make):
    rng = random.Random(1)
    for _ in range(5):
        key = make(rng)
        plain, block = base64.b64encode(key).decode(), armour("RSA ", key)
        assert found(f"é key={plain} end") == [("key", plain)]
        assert found(f"é key:{key.hex()} end") == [("key", key.hex())]
        assert found(f"x\n{block}\ny") == [("pem", block)]
        assert found(block.replace("\n", "\\n")) == [("pem", block.replace("\n", "\\n"))]


@pytest.mark.parametrize("make", MAKERS)
def test_broken_structures_are_not(make):
    rng = random.Random(2)
    key = make(rng)
    for broken in (key[:-9], b"\x31" + key[1:], key[:1] + bytes([key[1] ^ 1]) + key[2:], key[:5] + key[7:]):
        if broken[0] == ord("o") and broken[:15] == secrets.OPENSSH:
            broken = broken[:20] + b"\xff" + broken[21:]
        assert found("key " + base64.b64encode(broken).decode()) == []
        assert found("key " + broken.hex()) == []
        assert found(armour("", broken)) == []


def test_random_letters_are_not_keys():
    rng = random.Random(3)
    for _ in range(300):
        body = rng.randbytes(rng.randrange(24, 400))
        assert found(base64.b64encode(b"\x30\x82" + body).decode()) == []
    public = der(0x30, der(0x30, der(0x06, bytes.fromhex("2a864886f70d010101")), der(0x05)), der(0x03, b"\0" + rng.randbytes(140)))
    assert found(base64.b64encode(public).decode()) == []


def test_signed_tokens():
    good = token()
    assert found(f"Bearer {good}, and") == [("jwt", good)]
    assert found(f"{good} {token('RS256', 256)}") == [("jwt", good), ("jwt", token("RS256", 256))]
    assert found(token("HS256", 31)) == found(token("none", 32)) == found(token(payload=b"[1]")) == []
    assert found("eyJ.eyJ.x") == found(good.rpartition(".")[0]) == []
    assert found(f"a.b.{good}.c.d") == [("jwt", good)]


def plain_base(text):
    """Leftmost matches by trying every place in turn."""
    out = []
    word = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    kinds = [(word + r"[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", 6), ("(AKIA[A-Z0-9]+)", 20), ("([0-9a-f]+)", 24)]
    for kind, (pattern, least) in enumerate(kinds):
        at, compiled = 0, re.compile(pattern)
        while at < len(text):
            hit = compiled.match(text, at)
            if hit and len(hit[1]) >= least:
                out.append((hit.start(), kind, hit.end()))
            at = hit.end() if hit else at + 1
    return sorted(out)


def test_base_spans_against_a_plain_reading():
    rng = random.Random(5)
    bits = ["token", "secret=", "passwd", "PassWord", "api_key", "APIKEY", ": ", "=", '"', "'", " ", "é", "abc12", "\n",
            "AKIA", "ABCD1234EFGH5678", "0123456789abcdef", "deadbeefdeadbeef", "x", "ſecret=abcdefg", "toKen=abcdefgh"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40)))
        assert sorted(secrets.base_spans(text)) == plain_base(text), text


def test_scan_of_a_table(spark, documents, clashing, no_documents):
    rng = random.Random(6)
    block, key = armour("", pkcs8(rng)), base64.b64encode(ec_key(rng)).decode()
    text = f"é token = '{token()}' {block} {key}"
    extra = spark.createDataFrame([(20, text), (20, text), (None, "secret: abcdef"), (21, None), (22, "")], "doc_id bigint, text string")
    rows = secrets.scan(extra).collect()
    assert len(rows) == 5
    twice = [r for r in rows if r["doc_id"] == 20]
    assert twice[0] == twice[1] and twice[0]["n_confirmed"] == 3 and twice[0]["n_assign"] == 1
    kinds = [s.split(":")[0] for s in twice[0]["spans"].split(",")]
    assert kinds == ["assign", "jwt", "pem", "key"]
    start, end = map(int, twice[0]["spans"].split(",")[2].split(":")[1:])
    assert text[start:end] == block
    empty = [r for r in rows if r["doc_id"] in (21, 22)]
    assert all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)
    assert secrets.scan(clashing).count() == documents.count() and secrets.scan(no_documents).count() == 0


@pytest.mark.parametrize("bit", ["MIIE", "eyJ", "a.", "eyJa.eyJ.", "token ", "3082", "-----BEGIN PRIVATE KEY-----\n", "AKIA", "M", "token: "])
def test_time_grows_with_the_text_only(bit):
    text = bit * (400_000 // len(bit))
    begin = time.process_time()
    secrets.base_spans(text)
    secrets.confirmed_spans(text)
    assert time.process_time() - begin < 4
