import base64
import hashlib
import json
import re

import duckdb
from hypothesis import given as holds_for
from hypothesis import settings
from hypothesis import strategies as st

from driftmon.llm import secret_scan as scan
from driftmon.llm.queries import op7_secrets

ASSIGN = re.compile(
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_spans(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def line(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def tlv(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82, n >> 8, n & 255])
    return bytes([tag]) + size + body


def number(n):
    return tlv(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


RSA = tlv(0x30, number(0) + b"".join(number(3**k) for k in range(60, 460, 50)))
EC = tlv(0x30, number(1) + tlv(4, b"k" * 32) + tlv(0xA0, tlv(6, b"\x2a\x86\x48")))
WRAPPED = tlv(0x30, number(0) + tlv(0x30, tlv(6, b"\x2a\x86\x48")) + tlv(4, EC))


def lengths(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


SSH = scan.SSH_MAGIC + lengths(b"none", b"none", b"") + (1).to_bytes(4, "big") + lengths(b"p" * 51, b"s" * 144)


def b64(data):
    return base64.b64encode(data).decode()


def jwt(head):
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    return f"{part(head)}.{part({'sub': 'x'})}.c2lnbmF0dXJl"


def kinds(text):
    return [(k, text[a:b]) for k, a, b in scan.spans(text) if k in ("jwt", "der", "ssh")]


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smaller one holds no secrets
    docs = {d: t or "" for d, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()}
    got = op7_secrets(spark, sf_dir).collect()
    assert len(got) == len(docs) and any(r.n_assign for r in got)
    for r in got:
        base = base_spans(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, *_ in base) for x in scan.BASE)
        assert r.base_sha256 == hashlib.sha256(line(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in scan.BASE] == [s for s in line(base).split(",") if s]


@settings(max_examples=400, deadline=None)
@holds_for(
    st.lists(
        st.sampled_from(["password", "Token", "API_key", "apikey", "ſecret", "=", ":", " ", '"', "abcdefgh", "AKIA", "A1B2C3D4E5F6", "0123456789abcdef", "é", ",", "\n"]),
        max_size=12,
    ).map("".join)
)
def test_base_spans_of_any_text(text):
    assert [s for s in scan.spans(text) if s[0] in scan.BASE] == base_spans(text)


def test_keys_and_tokens_are_confirmed_by_structure():
    body = "\n".join(re.findall(".{1,64}", b64(RSA)))
    assert kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----") == [("der", body)]
    one_line = body.replace("\n", "\\n")
    assert kinds(f'"key": "{one_line}\\n"') == [("der", one_line)]
    assert kinds(f"{b64(RSA)}\nand more words") == [("der", b64(RSA))]
    assert kinds(f"k: {b64(EC)} .") == [("der", b64(EC))]
    assert kinds(f"k: {b64(WRAPPED)}") == [("der", b64(WRAPPED))]
    assert kinds(f"é {EC.hex()} x") == [("der", EC.hex())]
    assert kinds(f"key {b64(SSH)}") == [("ssh", b64(SSH))]
    token = jwt({"alg": "HS256", "typ": "JWT"})
    assert kinds(f"Bearer {token} ok") == [("jwt", token)]


def test_keys_are_found_after_any_character():
    for data, kind in ((RSA, "der"), (EC, "der"), (WRAPPED, "der"), (SSH, "ssh")):
        one = b64(data)
        lines = re.findall(".{1,64}", one)
        for gap in ("\\n", "\\r\\n", "\n", "\r\n"):
            body = gap.join(lines)
            text = f'{{"private_key": "-----BEGIN PRIVATE KEY-----{gap}{body}{gap}-----END PRIVATE KEY-----{gap}"}}'
            assert kinds(text) == [(kind, body)], gap
        for before in ("-----BEGIN PRIVATE KEY-----", "key_", "path/", "n", "MIIE", "b3Blbn", "Mb", "x\nMII"):
            assert kinds(f"{before}{one}") == [(kind, one)], before
            assert kinds(f"{before}{one} {before}{one}") == [(kind, one)] * 2, before
            bare = one.rstrip("=")
            assert kinds(f"{before}{bare}-----END PRIVATE KEY-----") == [(kind, bare)], before
            assert kinds(f"{before}{b64(data[:-1])}") == [], before
        safe = base64.urlsafe_b64encode(data).decode()
        assert kinds(f"path/{safe}") == [(kind, safe)]


def test_many_beginnings_in_one_run_are_no_trouble():
    assert kinds("MIIEowIBAAKCAQEA" * 50_000) == []


def test_what_only_looks_like_a_secret_is_not_reported():
    broken = bytearray(RSA)
    broken[3] ^= 1
    for text in (
        b64(bytes(broken)),
        b64(RSA[:-1]),
        b64(RSA + b"\0"),
        b64(SSH[:-3]),
        b64(b"M" * 90),
        jwt({"typ": "JWT"}),
        jwt(["alg"]),
        b64(tlv(0x30, tlv(0x30, tlv(6, b"\x2a")) + tlv(3, b"\0" * 80))),  # a public key
        "M" * 5000,
        "3082" + "00" * 60,
    ):
        assert kinds(text) == [], text[:40]


def test_odd_rows(odd, none):
    rows = scan.digest_columns(scan.scan_secrets(odd)).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id: r.spans for r in rows if r.spans} == {10: "hex:0:50000"}
    assert scan.scan_secrets(none).count() == 0


def test_tokens_are_found_after_any_character():
    token = jwt({"alg": "HS256", "typ": "JWT"})
    for before in ("\\n", "token%3D", "_", "-", "a", "x.y.", "eyJ", "eyJhbGciOiJ", "Bearer ", "\\u0022", "/"):
        got = [s for s in scan.spans(before + token + '"') if s[0] == "jwt"]
        assert got == [("jwt", len(before), len(before) + len(token))], before
    both = f"{token},\\n{token}"
    assert [s[1] for s in scan.spans(both) if s[0] == "jwt"] == [0, len(token) + 3]
    no_header = jwt({"typ": "JWT"})
    assert not [s for s in scan.spans(no_header) if s[0] == "jwt"]
    assert not [s for s in scan.spans("eyJ" * 20_000 + ".a.b") if s[0] == "jwt"]


def test_hex_keys_are_found_after_any_digit():
    for key in (RSA, EC, WRAPPED):
        for upper in (False, True):
            digits = key.hex().upper() if upper else key.hex()
            for before in ("", "ab", "a", "key ", "0x", "30", "3082"):
                for after in ("", "00", " end"):
                    got = [s for s in scan.spans(before + digits + after) if s[0] == "der"]
                    assert got == [("der", len(before), len(before) + len(digits))], (before, after)
            spread = ":".join(digits[i : i + 2] for i in range(0, len(digits), 2))
            for before in ("", "key=", "ab:", "\\n"):
                got = [s for s in scan.spans(before + spread + ":00") if s[0] == "der"]
                assert got == [("der", len(before), len(before) + len(spread))], before
    assert not [s for s in scan.spans(RSA.hex()[:-2]) if s[0] == "der"]
    assert not [s for s in scan.spans("30" * 50_000) if s[0] == "der"]
