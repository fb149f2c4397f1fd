"""Top-k search, secrets and personal data."""

import base64
import datetime as dt
import hashlib
import ipaddress
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import pii, secrets, topk
from tests.llm.conftest import ODD, table


# ------------------------------------------------------------ top-k search
def brute_top(rows, k, scale=64):
    fine = [(i, [int(np.floor(x * scale)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for q, a in fine:
        if q % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q)[:k]
            out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return out


@pytest.mark.parametrize("shard_rows,block_rows,k", [(10_000, 10_000, 20), (60, 4, 7), (9, 3, 3)])
def test_top_k_against_brute_force(spark, shard_rows, block_rows, k):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8).round(1)]) for i in range(300)]
    rows += [(300 + i, [0.25] * 8) for i in range(40)]  # one very common vector: ties
    rows += [(1000, None), (1001, [None] * 8), (1020, [float("nan")] * 8), (1021, [float("inf"), *[0.0] * 7]), (1040, [1.0, 2.0]), (1041, []), (None, [0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("shard", F.lit(2))
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=k, shard_rows=shard_rows, block_rows=block_rows)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute_top(rows, k)


def test_top_k_large_numbers_and_empty(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 2.0]), (2, [-3e7, 1.0]), (3, [1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    assert got[1] == (64 * 30_000_000) ** 2 + 64 * 128 and got[2] == -((64 * 30_000_000) ** 2) + 64 * 64 and got[3] == 2**63 - 1
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_search_leaves_nodes_out():
    rng = np.random.default_rng(2)
    x = np.floor(np.concatenate([rng.normal(c, 1, (400, 6)) for c in (-60, 0, 60)]))
    looked = []
    dots = topk._dots
    topk._dots = lambda a, b: looked.append(len(b)) or dots(a, b)
    try:
        topk.search(x, np.arange(len(x)), x[:1] + 1, np.array([-1]), np.array([-np.inf]), 5)
    finally:
        topk._dots = dots
    assert sum(looked) < 800


# ----------------------------------------------------------------- secrets
def brute_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{secrets.KINDS[k]}:{a}:{z}" for a, k, z in sorted(found)]


def test_base_spans_against_brute_force(spark):
    rng = random.Random(9)
    bits = ["password", "Secret", "api_key", "APIKEY", "token", "ſecret", "passwd", " ", "=", ": ", '"', "'", "abc", "abcdef", "x" * 5, "AKIA", "ABCD1234EFGH5678", "0123456789abcdef" * 2, "deadbeef", "é", "🙂", "\n", "/+-_."]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40))), None, None) for i in range(400)]
    got = {r.doc_id: r for r in secrets.report(secrets.find_secrets(table(spark, rows))).collect()}
    for i, t, *_ in rows:
        want = brute_base(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("random")] == want
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))


def test_battery_is_uniform_on_random_and_low_on_words():
    rng = np.random.default_rng(3)
    for alphabet in secrets.ALPHABETS[1:9]:
        tokens = [bytes(rng.choice(list(alphabet), 48).tolist()) for _ in range(1500)]
        p = secrets._scores(tokens)
        assert 0.3 < np.mean(p) < 0.7 and np.mean(p < 0.01) < 0.05
    assert secrets._scores([b"thisisaverylongrunofenglishwordswithoutblanks", b"a" * 40, b"abababababababababababababababab", b"abcdefghijklmnopqrstuvwxyz0123456789"]).max() < 0.01


def test_random_spans_are_found(spark, small):
    rng = np.random.default_rng(8)
    texts = [r.text for r in small.collect()]
    keys = [base64.b64encode(rng.bytes(30 + i)).decode().rstrip("=") for i in range(12)]
    rows = [(i, f"{t} {keys[i] if i < 12 else ''} /usr/local/share/application/data/files", None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in secrets.find_secrets(table(spark, rows)).collect()}
    found = {i: [rows[i][1][s["start"] : s["end"]] for s in got[i].spans if s["kind"] == "random"] for i in got}
    assert sum(keys[i] in "".join(found[i]) for i in range(12)) >= 9
    assert not any(found[i] for i in range(12, len(rows)))


def test_secrets_odd_and_empty(odd, none):
    got = secrets.report(secrets.find_secrets(odd)).collect()
    assert len(got) == len(ODD) and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got)
    assert secrets.find_secrets(none).count() == 0


# ----------------------------------------------------------- personal data
def test_feistel_is_a_bijection():
    f = pii.Feistel(b"k")
    for radices in ([10, 10, 10], [26, 10], [7], [3, 5, 2, 4]):
        n = pii._product(radices)
        out = [f.run(pii._symbols(i, radices), radices, "t") for i in range(n)]
        assert sorted(pii._number(o, radices) for o in out) == list(range(n))
        assert all(pii._number(f.run(o, radices, "t", back=True), radices) == i for i, o in enumerate(out))


TEXT = ("mail Bob.x9@mail3.example.com at 30.131.197.223, card 4111 1111 1111 1111, call +1 (263) 555-5300 or 212-555-0199; ssn 123-45-6789, "
        "born 1984-02-29 (02/29/1984, 29/02/1984, 5.3.2020), iban DE89 3704 0044 0532 0130 00 é")


def test_formats_and_validity():
    f = pii.Feistel(b"k")
    new, found = pii.pseudonyms(TEXT.encode(), f)
    assert [k for _, _, k in found] == ["email", "ip", "card", "phone", "phone", "ssn", "date", "date", "date", "date", "iban"]
    again, kinds = pii.pseudonyms(new, f)
    assert [k for _, _, k in kinds] == [k for _, _, k in found]  # all still valid in their formats
    assert pii.pseudonyms(new, f, back=True)[0] == TEXT.encode()
    for a, z, k in found:
        assert TEXT.encode()[a:z] not in new
    assert pii.pseudonyms(TEXT.encode(), pii.Feistel(b"other"))[0] != new


def test_invalid_values_stay():
    for t in ["4111 1111 1111 1112", "300.1.1.1", "666-12-3456", "1984-02-30", "DE89 3704 0044 0532 0130 01", "version 3.14.15", "1234567890123456"]:
        assert pii.pseudonyms(t.encode(), pii.Feistel(b"k"))[0] == t.encode(), t


def test_pseudonyms_link_across_documents(spark, odd, none):
    docs = table(spark, [(1, "a bob@x.example.org b", None, None), (2, "BOB@x.example.org", None, None), (3, "ann@x.example.org", None, None), (4, TEXT, None, None)])
    got = {r.doc_id: r.text for r in pii.pseudonymise(docs, b"key").collect()}
    assert got[1].split()[1] == got[2].lower() != got[3]
    assert got[1].split("@")[1].split()[0] == got[3].split("@")[1]  # the same host
    back = {r.doc_id: r.text for r in pii.reveal(spark.createDataFrame(list(got.items()), "doc_id long, text string"), b"key").collect()}
    assert back[4] == TEXT and back[1] == "a bob@x.example.org b"
    rows = pii.pseudonymise(odd, b"key").collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, *_ in ODD)
    assert pii.pseudonymise(none, b"key").count() == 0


def test_values_in_texts_of_few_digits(spark):
    rich = "host 8.8.8.8 and 10.0.0.1, order 1234567890"
    docs = table(spark, [(i, t, None, None) for i, t in enumerate(["host 8.8.8.8", rich, "10.0.0.1", "on 1.2.2020", "GB85ABCDEFGHIJKLMNOPQR", "no digits", "v 1.2.3"])])
    got = {r.doc_id: r for r in pii.pseudonymise(docs, b"key").collect()}
    assert [got[i].n_ip for i in range(7)] == [1, 2, 1, 0, 0, 0, 0] and got[3].n_date == 1
    assert got[0].text != "host 8.8.8.8" and got[0].text.split()[1] == got[1].text.split()[1]
    assert got[2].text == got[1].text.split()[3].rstrip(",") != "10.0.0.1"
    assert got[4].n_iban == 1 and got[5].text == "no digits" and got[6].text == "v 1.2.3"


CARD, IBAN = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"


def test_values_beside_other_tokens():
    for form, value, kind in [
        ("{} 12/27", CARD, "card"), ("{} 123", CARD, "card"), ("27 {}", CARD, "card"), ("27 {} 12/27 123", CARD, "card"), ("card-{}-", CARD.replace(" ", "-"), "card"),
        ("1 {} 5", CARD.replace(" ", ""), "card"), ("{} 99", "3782 822463 10005", "card"), ("on 2020-01-15 {}", CARD, "card"),
        ("{} BIC COBADEFFXXX", IBAN, "iban"), ("{} 4 EUR", IBAN, "iban"), ("AB12 {}", IBAN, "iban"), ("{} A", "GB82 WEST 1234 5698 7654 32", "iban"), ("{} BIC", IBAN.replace(" ", ""), "iban")]:
        for key in range(12):
            f = pii.Feistel(bytes([key]))
            text = form.format(value).encode()
            new, found = pii.pseudonyms(text, f)
            spans = [(text[a:z].decode(), k) for a, z, k in found if k != "date"]
            assert spans == [(value, kind)] and value.encode() not in new, (form, spans)
            assert pii.pseudonyms(new, f, back=True)[0] == text
    f = pii.Feistel(b"k")
    alone = pii.pseudonyms(CARD.encode(), f)[0]
    assert pii.pseudonyms(f"{CARD} 12/27".encode(), f)[0] == alone + b" 12/27"
    two = f"{IBAN} {CARD} 5500 0000 0000 0004 123".encode()
    new, found = pii.pseudonyms(two, f)
    assert [(two[a:z].decode(), k) for a, z, k in found] == [(IBAN, "iban"), (CARD, "card"), ("5500 0000 0000 0004", "card")]
    assert pii.pseudonyms(new, f, back=True)[0] == two


#: Values and texts that hold none, by kind.
FORMS = {
    "phone": (["06 12 34 56 78", "+33 1 23 45 67 89", "01.23.45.67.89", "(555) 234-5678"], ["0612345678", "00 12 34 56 78", "06 12 34 56", "06 12.34 56 78", "1 06 12 34 56 78"]),
    "date": (["12-03-2020", "2020/03/12", "2020.03.12", "12 March 2020", "March 12, 2020", "Mar 3, 1999", "05 May 2001", "1.2.2003"],
             ["2020/13/12", "31-02-2020", "12 Marsh 2020", "32 March 2020", "March 12 2020", "2020-03/12", "12.03.2020.5", "Mayor 3, 1999"]),
    "card": (["4111.1111.1111.1111", "5500.0000.0000.0004"], ["4111.1111.1111.1112", "4111.1111.1111.1111.2", "0.4111.1111.1111.1111"]),
    "ip": (["2001:db8::1", "fe80::1ff:fe23:4567:890a", "2001:0DB8:85A3:0000:0000:8A2E:0370:7334", "8.8.8.8"], ["12:30:45", "std::vector", "::", "2001:db8::1::2", "00:1A:2B:3C:4D:5E", "Fe80::aB"]),
    "iban": (["de89370400440532013000", "fr14 2004 1010 0505 0001 3m02 606", "DE89 3704 0044 0532 0130 00"], ["de88370400440532013000", "De89370400440532013000", "xde89370400440532013000"]),
}


@pytest.mark.parametrize("kind", FORMS)
@pytest.mark.parametrize("frame", ["{}", "see {} now", "({}), 7"])
def test_more_forms(kind, frame):
    f = pii.Feistel(b"another key")
    for value in FORMS[kind][0]:
        text = frame.format(value).encode()
        new, found = pii.pseudonyms(text, f)
        start = text.index(value.encode())
        assert found == [(start, start + len(value), kind)], (value, found)
        assert value.encode() not in new and pii.pseudonyms(new, f, True)[0] == text, (value, new)
    for value in FORMS[kind][1]:
        assert kind not in [k for *_, k in pii.pseudonyms(frame.format(value).encode(), f)[1]], value


def test_new_values_are_valid_and_linked():
    f = pii.Feistel(b"k")
    for i in range(300):
        day = 1 + i % 28
        new = pii.pseudonyms(f"{day} June {1900 + i % 200}".encode(), f)[0].decode()
        dt.datetime.strptime(new, "%d %B %Y")
        ip = pii.pseudonyms(f"2001:db8:{i:x}::{i * 7:x}".encode(), f)[0].decode()
        ipaddress.IPv6Address(ip)
    one = {pii.pseudonyms(f"{c}@{h}.example.com".encode(), f)[0] for c in "abcdefghijklmnopqrstuvwxyz" for h in ("mail", "post")}
    assert len(one) == 52
    shift = [(pii.pseudonyms(f"a@{h}.example.com".encode(), f)[0][0] - 97) % 26 for h in ("mail", "post", "www", "x1", "y2")]
    assert len(set(shift)) > 1  # a single letter is not shifted by a constant


def test_planted_values_against_a_plain_scan(spark, small):
    """Values written into given texts are found where a plain list of them says."""
    rng = random.Random(9)
    values = [(k, v) for k, (good, _) in FORMS.items() for v in good]
    rows, want = [], {}
    for r in small.collect()[:60]:
        words = (r.text or "").split()[:80]
        words = [w for w in words if not any(c.isdigit() or c in "@:" for c in w)]
        chosen = rng.sample(values, 3)
        for k, v in chosen:
            words.insert(rng.randrange(len(words) + 1), f"; {v} ;")
        rows.append((r.doc_id, " ".join(words), None, None))
        want[r.doc_id] = Counter(k for k, _ in chosen)
    for r in pii.pseudonymise(table(spark, rows), b"key").collect():
        assert {k: r[f"n_{k}"] for k in pii.KINDS if r[f"n_{k}"]} == want[r.doc_id], r.text
        assert not any(f"; {v} ;" in r.text for _, v in values)
