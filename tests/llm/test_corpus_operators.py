"""The corpus operators against brute force, round trips and held-out labels."""

import io
import random
import re
import zlib
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR, rows_of
from tillhouse.llm import decontaminate, embeddings, license_rules, licenses, mixing, pii, queries, simhash, tokens, toxicity, warc
from tillhouse.llm.common import ROW, components, keep
from tillhouse.session import shared_dir


def unions(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)] + [(700, i) for i in range(701, 760)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = unions(edges, {n for e in edges for n in e})
    assert found == {n: r for n, r in expected.items() if any(n in e and e[0] != e[1] for e in edges)}


# 1: mixing


def test_mix_meets_targets_and_bounds(spark):
    rows = [(i, "w " * (1 + i * i % 50), ["a", "b", "c", None][0 if i % 3 else i % 4]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.allotment(docs).withColumn("source", F.lit(None)).join(docs.select("doc_id", F.col("source").alias("s")), "doc_id").collect()
    by = {}
    for r in found:
        by.setdefault(r.s, []).append(r)
        assert r.taken in {0, r.size, 2 * r.size, 3 * r.size}
    for group in by.values():
        target = group[0].target
        assert target <= 3 * group[0].source_size
        assert abs(sum(r.taken for r in group) - target) <= max(0.02 * target, 60)
    assert sum(g[0].target for g in by.values()) == pytest.approx(sum(r.size for r in found))


@pytest.mark.parametrize("sizes", [[1000, 10, 10], [5, 5, 5], [0, 7, 100], [1, 1, 1, 100000], [0, 0]])
def test_targets_by_repeated_sharing(spark, sizes):
    weighted = spark.createDataFrame([(f"s{i}", n, i % 3 + 1) for i, n in enumerate(sizes)], "source string, source_size long, weight long")
    found = {r.source: r.target for r in mixing.targets(weighted).collect()}
    target, open_, left = {}, {i: i % 3 + 1 for i in range(len(sizes))}, sum(sizes)
    while open_:
        level = left / sum(open_.values())
        over = [i for i, w in open_.items() if w * level > 3 * sizes[i]]
        if not over:
            target.update({i: w * level for i, w in open_.items()})
            break
        for i in over:
            target[i] = 3 * sizes[i]
            left -= target[i]
            del open_[i]
    assert found == pytest.approx({f"s{i}": t for i, t in target.items()})


# 2: licences


def brute_licenses(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    line = f" {' '.join(words)} "

    def spans(regex):
        return [(line[:m.start()].count(" ") - 1, line[:m.end()].count(" ")) for m in re.finditer(regex, line)]

    base = [(label, s) for phrase, label in licenses.BASE.items() for s, _ in spans(rf"(?<= ){phrase}(?= )")]
    found = [(s, -e, r.rank, r.label, r.certainty) for r in license_rules.rules() if r.keyword in words for s, e in spans(r.regex)]
    outer = [d for d in found if not any(o != d and o[0] <= d[0] and o[1] <= d[1] and ((o[0], o[1]) != (d[0], d[1]) or o[2] < d[2]) for o in found)]
    outer.sort()
    kept = [
        d for i, d in enumerate(outer)
        if not any(0 <= j < len(outer) and outer[j][2] < d[2] and max(outer[j][0], d[0]) < min(-outer[j][1], -d[1]) for j in (i - 1, i + 1))
    ]
    starts = [s for _, s in base]
    labels = sorted({*(b for b, _ in base), *(d[3] for d in kept)})
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for b, _ in base})), ",".join(labels),
        max([d[4] for d in kept] + [0.7 if base else 0.0]),
    )


LICENSE_TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: GPL-2.0-or-later and see https://www.gnu.org/licenses/gpl-2.0.html",
    "under CC BY-NC 4.0 or CC BY CC BY 3.0", "MIT License MIT license mit license", "redistribution and use in source and binary forms, with or without modification",
    "The GNU Lesser General Public License v2.1, or GNU General Public License version 3; all rights reserved", "no words about it", "apache", "",
    "released under the terms of the Mozilla Public License 2.0 https://mozilla.org/MPL/2.0/ and BSD 3-Clause License",
]


def test_licenses_against_brute_force(spark):
    texts = LICENSE_TEXTS + [r[1] for r in rows_of("documents")] + [r.text for r in queries.table(spark, SF_DIR, "documents").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == brute_licenses(texts[r.doc_id])


def test_overlapping_spans_are_settled_by_rank(spark):
    """Chains of spans against brute force; of three in a chain, the outer two stay when the last beats the middle one."""
    rng = random.Random(3)
    chain = ("ab", "bc", "cd")
    tables = [[chain[i] for i in order] for order in ((2, 1, 0), (0, 1, 2), (1, 0, 2))]
    tables += [rng.sample(["abc", "bcd", "cde", "def", "efa", "ab", "cd", "de", "fa"], 7) for _ in range(4)]
    texts = ["a b c d", "a b c d e f a b c d", "c d e f a b"] + [" ".join(rng.choices("abcdef", k=30)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for table in tables:
        extra = [license_rules.Rule(i, p, p[0], 1.0, rf"(?<= ){' '.join(p)}(?= )") for i, p in enumerate(table)]
        for r in licenses.detect(docs, extra).select(f"{ROW}.text", "detections").collect():
            plain = r.text.replace(" ", "")
            spans = [(i, m.start(), m.start() + len(p)) for i, p in enumerate(table) for m in re.finditer(p, plain)]
            outer = [s for s in spans if not any(o != s and o[1] <= s[1] and s[2] <= o[2] for o in spans)]
            kept = []
            for s in sorted(outer):
                if not any(o[1] < s[2] and s[1] < o[2] for o in kept):
                    kept.append(s)
            assert sorted((d.start, d.end, d.rank) for d in r.detections) == sorted((s[1], s[2], s[0]) for s in kept)


def test_every_version_of_creative_commons_has_its_own_label(spark):
    kinds = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
    cases = {}
    for kind in kinds:
        for version in ("4.0", "3.0", "2.5", "2.0", "1.0"):
            cases[f"see https://creativecommons.org/licenses/{kind}/{version}/ for it"] = f"cc-{kind}-{version}"
            cases[f"SPDX-License-Identifier: CC-{kind.upper()}-{version} here"] = f"cc-{kind}-{version}"
            cases[f"under CC {kind.upper()} {version}, see"] = f"cc-{kind}-{version}"
        cases[f"see https://creativecommons.org/licenses/{kind}/ for it"] = f"cc-{kind}"
        cases[f"SPDX-License-Identifier: CC-{kind.upper()} here"] = f"cc-{kind}"
    cases["see https://creativecommons.org/licenses/by/9.9/"] = "cc"
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r.text: {d.label for d in r.detections} for r in licenses.detect(docs).select(f"{ROW}.text", "detections").collect()}
    assert found == {text: {label} for text, label in cases.items()}


def test_every_rule_is_gated_by_a_word_it_needs():
    found = license_rules.rules()
    assert len(found) > 300
    for rule in found:
        assert re.search(rf"(?<![a-z0-9]){rule.keyword}(?![a-z0-9])", rule.regex), rule


# 3: pseudonyms


def test_permutation_is_one_to_one_and_inverts():
    p = pii.Permutation("k")
    for n in (1, 2, 7, 97, 1000):
        images = [p.forward(x, n, "t") for x in range(n)]
        assert sorted(images) == list(range(n))
        assert [p.backward(y, n, "t") for y in images] == list(range(n))


VALUES = [
    "4111 1111 1111 1111", "5500-0000-0000-0004", "4845168114407329", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "123-45-6789",
    "+1 (017) 555-7713", "(212) 555-0100", "192.168.1.250", "jane.doe42@example.com", "2024-02-29", "31.12.1999", "02/28/2001", "1987/06/05",
]


@pytest.mark.parametrize("value", VALUES)
def test_pseudonyms_keep_the_format_and_invert(value):
    p = pii.Permutation("k")
    text = f"x {value}, again {value}. 1"
    if pii.card(value, p.forward) is None and value.isdigit():
        value = value[:-1] + str(pii.luhn_digit(value[:-1]))
        text = f"x {value}, again {value}. 1"
    new, counts = pii.replace(text, p.forward)
    assert sum(counts.values()) == 2 and value not in new
    a, b = re.fullmatch(r"x (.*), again (.*)\. 1", new).groups()
    assert a == b
    shape = lambda s: re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", s))
    if "." not in value or "@" in value or not value.replace(".", "").isdigit():
        assert re.sub("[a-z]", "a", shape(a)) == re.sub("[a-z]", "a", shape(value))
    assert pii.replace(new, p.backward)[0] == text


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "999.1.1.1", "2023-02-29", "000-12-3456", "version 1.2.3", "DE00 3704 0044 0532 0130 00", "a1234567890123456b", "", "no digits"])
def test_what_fails_validation_stays(text):
    assert pii.replace(text, pii.Permutation("k").forward)[0] == text


def test_neighbouring_numbers():
    move = pii.Permutation("k").forward
    for text in ("12 4111111111111111", "4111111111111111 12", "4111111111111111 5500000000000004"):
        new, counts = pii.replace(text, move)
        assert counts["card"] == text.count("1111111111111") + text.count("0000000000004") and len(new) == len(text)


@pytest.mark.parametrize("value, rest", [("2024-01-31", "T10:00:00Z"), ("2024/01/31", "T10:00"), ("31/12/2023", ""), ("13/01/1999", "")])
def test_more_forms_of_dates(value, rest):
    p = pii.Permutation("k")
    text = f"x {value}{rest}, again {value}{rest}."
    new, counts = pii.replace(text, p.forward)
    a, b = re.fullmatch(rf"x (.*){rest}, again (.*){rest}\.", new).groups()
    assert counts["date"] == 2 and a == b != value
    assert re.sub(r"\d", "9", a) == re.sub(r"\d", "9", value) and pii.replace(new, p.backward)[0] == text


def test_a_date_stays_linked_in_every_form_and_no_two_slashed_dates_meet():
    p = pii.Permutation("k")
    iso, stamp, day_first = (pii.replace(t, p.forward)[0] for t in ("2023-12-31", "2023-12-31T10", "31/12/2023"))
    assert stamp == f"{iso}T10" and day_first == "/".join(reversed(iso.split("-")))
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(2000)]
    slashed = {f"{d:%d/%m/%Y}" for d in days} | {f"{d:%m/%d/%Y}" for d in days}
    assert len({pii.replace(t, p.forward)[0] for t in slashed}) == len(slashed)


NATIONAL = ["06 12 34 56 78", "+33 6 12 34 56 78", "01.23.45.67.89", "0612345678", "030 1234567", "0171/1234567", "+49 171 1234567", "+49 30 123 456 78",
            "612 345 678", "+34 612 345 678", "912-34-56-78"]


@pytest.mark.parametrize("value", NATIONAL)
def test_national_phone_numbers(value):
    p = pii.Permutation("k")
    text = f"call {value}, or {value}. 2"
    new, counts = pii.replace(text, p.forward)
    a, b = re.fullmatch(r"call (.*), or (.*)\. 2", new).groups()
    assert counts["phone"] == 2 and a == b != value and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", value)
    assert pii.replace(new, p.backward)[0] == text


def test_a_number_is_linked_with_and_without_its_country_code():
    move = pii.Permutation("k").forward
    for inland, abroad in (("06 12 34 56 78", "+33 6 12 34 56 78"), ("0171 1234567", "+49 171 1234567"), ("612 345 678", "+34 612 345 678")):
        a, b = (re.sub(r"\D", "", pii.replace(t, move)[0]) for t in (inland, abroad))
        assert a.lstrip("0") == b[2:]


@pytest.mark.parametrize("value", ["2001:db8::8a2e:370:7334", "2001:0DB8:0000:0000:0000:8A2E:0370:7334", "fe80::abcd"])
def test_ipv6(value):
    import ipaddress

    p = pii.Permutation("k")
    new, counts = pii.replace(f"from {value} on", p.forward)
    assert counts["ipv6"] == 1 and pii.replace("from 2001:db8::8a2e:370:7334 on", p.forward)[0] == (new if "370" in value else pii.replace("from 2001:db8::8a2e:370:7334 on", p.forward)[0])
    back = pii.replace(new, p.backward)[0].split()[1]
    assert ipaddress.ip_address(back) == ipaddress.ip_address(value) != ipaddress.ip_address(new.split()[1])
    for text in ("at 12:34:56", "::", "::1", "a::b::c", "std::vector", "12:34"):
        assert pii.replace(text, p.forward)[0] == text


def test_whole_query_inverts(spark):
    """Every text of the table comes back under the inverse, and differs from its pseudonyms in letters and digits alone."""
    p = pii.Permutation(queries.pseudonym_key(spark))
    texts = {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}
    rows = queries.op3_pseudonyms(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts) and sum(r.n_email + r.n_phone for r in rows) > 0
    for r in rows:
        found = {name: r[f"n_{name}"] for name in pii.NAMES}
        assert pii.replace(texts[r.doc_id], p.forward) == (r.text, found)
        if not r.n_ipv6 and not r.n_ipv4:
            assert pii.replace(r.text, p.backward)[0] == texts[r.doc_id]
            assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", r.text))) == re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", texts[r.doc_id])))


def test_a_cluster_needs_a_key():
    class Cluster:
        conf = {"x": 1}
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError):
        queries.pseudonym_key(Cluster())
    Cluster.conf = {"spark.tillhouse.pseudonym.key": "own"}
    assert queries.pseudonym_key(Cluster()) == "own"


def test_equal_values_stay_linked_across_documents(spark):
    docs = spark.createDataFrame([(1, "mail jane@example.org"), (2, "JANE@example.org? jane@example.org"), (3, None), (4, "")], "doc_id long, text string")
    rows = {r.id: r.found for r in pii.pseudonymise(docs, "k").select(F.col(f"{ROW}.doc_id").alias("id"), "found").collect()}
    new = rows[1].text.split()[1]
    assert rows[2].text.endswith(new) and rows[2].text.lower().startswith(new) and rows[2].n_email == 2
    assert rows[3].text is None and rows[3].n_email == 0 and rows[4].text == ""


def test_bytes_that_are_no_utf8_come_through(spark):
    """Also where they touch a find, and where they are half of a character."""
    p = pii.Permutation("k")
    mail = pii.replace("jane@example.org", p.forward)[0].encode()
    texts = [b"mail jane@example.org\xff \xc3", b"\xe2\x82 jane@example.org", b"\xed\xa0\x80 1", b"\xff none", "caf\u00e9 \U0001f600 jane@example.org".encode()]
    docs = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
    rows = pii.pseudonymise(docs, "k").select(f"{ROW}.doc_id", F.col("found.text").cast("binary").alias("new"), "found.n_email").collect()
    assert {r.doc_id: bytes(r.new) for r in rows} == {i: t.replace(b"jane@example.org", mail) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_email for r in rows} == {i: t.count(b"@") for i, t in enumerate(texts)}


def test_answers_in_several_arrays_meet_their_rows(spark):
    """12 MB of long texts with nulls and empty ones in one partition, which Spark hands to Python at once."""
    move = pii.Permutation("k").forward
    texts = {i: (None, "", f"text {i} of jane{i}@example.org " + "word " * 200_000)[min(i % 4, 2)] for i in range(24)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    rows = pii.pseudonymise(docs, "k").select(f"{ROW}.doc_id", "found.text", "found.n_email").collect()
    assert [(r.doc_id, r.text, r.n_email) for r in rows] == [(i, t and pii.replace(t, move)[0], int(bool(t))) for i, t in texts.items()]


def test_answers_come_in_arrays_bounded_by_their_bytes():
    import pyarrow as pa

    move = pii.Permutation("k").forward
    texts = [None, "", "x" * 70, "mail jane@example.org", None, "y" * 300, "4111 1111 1111 1111", "", None]
    for kind in (pa.string(), pa.large_string()):
        parts = list(pii._answers(pa.array(texts, kind), move, 100))
        assert max(len("".join(r["text"] or "" for r in p.to_pylist()[:-1])) for p in parts) < 100
        assert len(parts) > 1 and [r["text"] for p in parts for r in p.to_pylist()] == [t and pii.replace(t, move)[0] for t in texts]
        assert sum(r["n_card"] + r["n_email"] for p in parts for r in p.to_pylist()) == 2
    assert list(pii._answers(pa.array([], pa.string()), move)) == []


# 4: WARC


def test_warc_round_trip_of_payloads(spark):
    pages = spark.createDataFrame(rows_of("pages"), "page_id long, url string, html string")
    folder = shared_dir(spark, "test-warc")
    files = warc.write_archives(warc.records(pages), folder, archive_bytes=600)
    assert files.count() > 1
    got = warc.read_archives(files, folder, with_payload=True).collect()
    payload = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    sent = Counter((p, (h or "").encode()) for p, _, h in rows_of("pages"))
    assert Counter((r.page_id, payload[r.payload_digest]) for r in got) == sent
    assert all(r.payload_bytes == len(payload[r.payload_digest]) for r in got)


def member(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def test_sequential_reader_rejects_damage(monkeypatch):
    import hashlib

    body = random.Random(0).randbytes(5000)
    good = warc.record_bytes(1, "http://a/", hashlib.sha256(body).hexdigest(), len(body), None, body)
    for size in (1, 7, 4096):
        monkeypatch.setattr(warc, "READ_BYTES", size)
        (record,) = warc.read_records(io.BytesIO(member(good)))
        assert record["payload"] == body
    two = list(warc.read_records(io.BytesIO(member(good) * 2)))
    assert len(two) == 2
    damaged = [good.replace(body[:9], b"123456789"), good[:-4], good + b"x", good[:300], b"no record\r\n\r\n"]
    for bad in damaged:
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(member(bad))))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_records(io.BytesIO(member(good)[:-20])))


def foreign(kind, block=b"", content_type=None, version="WARC/1.0", **fields):
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x:{kind}>"), ("WARC-Date", "2020-02-02T02:02:02Z")]
    lines += [(k.replace("_", "-"), v) for k, v in fields.items()] + ([("Content-Type", content_type)] if content_type else [])
    return warc._head([*lines, ("Content-Length", str(len(block)))], version) + block + b"\r\n\r\n"


def digest_field(algorithm, data, encoding):
    import base64
    import hashlib

    raw = hashlib.new(algorithm, data).digest()
    return f"{algorithm}:{base64.b32encode(raw).decode() if encoding == 'base32' else raw.hex()}"


HTTP, HTTP_REQUEST = "application/http; msgtype=response", "application/http; msgtype=request"
BODY = b"<p>the body of a page</p>"
CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + b"10\r\n" + BODY[:16] + b"\r\n%x;x=y\r\n" % (len(BODY) - 16) + BODY[16:] + b"\r\n0\r\n\r\n"
# Records as other crawlers write them: type, payload, and the record.
FOREIGN = [
    ("warcinfo", b"software: x\r\n", foreign("warcinfo", b"software: x\r\n", "application/warc-fields", WARC_Filename="a.warc.gz")),
    ("request", b"", foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", HTTP_REQUEST, WARC_Target_URI="http://a/")),
    ("response", BODY, foreign("response", b"HTTP/1.1 200 OK\r\nServer: y\r\n\r\n" + BODY, HTTP, WARC_Target_URI="<http://a/>")),
    ("response", BODY, foreign("response", b"HTTP/1.1 200 OK\r\n\r\n" + BODY, HTTP, WARC_Payload_Digest=digest_field("sha1", BODY, "base32"))),
    ("response", BODY, foreign("response", CHUNKED, HTTP, WARC_Payload_Digest=digest_field("sha1", BODY, "base32"))),
    ("response", BODY, foreign("response", CHUNKED, HTTP, WARC_Payload_Digest=digest_field("sha256", CHUNKED.partition(b"\r\n\r\n")[2], "hex"))),
    ("response", b"127.0.0.1", foreign("response", b"127.0.0.1", "text/dns", WARC_Target_URI="dns:a", WARC_Block_Digest=digest_field("md5", b"127.0.0.1", "hex"))),
    ("resource", BODY, foreign("resource", BODY, "text/html", WARC_Block_Digest=digest_field("sha512", BODY, "base32"), version="WARC/1.1")),
    ("metadata", b"via: x", foreign("metadata", b"via: x", "application/warc-fields", WARC_Concurrent_To="<urn:x>\r\n more of it")),
    ("conversion", BODY, foreign("conversion", BODY, "text/plain", WARC_Refers_To="<urn:x:response>")),
    ("revisit", None, foreign("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", HTTP, WARC_Refers_To_Target_URI="http://a/", WARC_Refers_To_Date="2019-01-01T00:00:00Z", WARC_Payload_Digest="sha1:ABC")),
    ("revisit", None, foreign("revisit", b"", HTTP)),
    ("response", b"", foreign("response", b"", HTTP)),
    ("unheard-of", b"1", foreign("unheard-of", b"1", WARC_Payload_Digest="crc9:77")),
]


@pytest.mark.parametrize("size", [1, 64, 1 << 18])
def test_reader_takes_every_type_of_record(monkeypatch, size):
    monkeypatch.setattr(warc, "READ_BYTES", size)
    data = b"".join(member(r) for _, _, r in FOREIGN)
    found = list(warc.read_records(io.BytesIO(data)))
    assert [(r["record_type"], r["payload"]) for r in found] == [(kind, payload) for kind, payload, _ in FOREIGN]
    assert all(r["error"] is None and r["date"] == "2020-02-02T02:02:02Z" for r in found)
    assert found[2]["url"] == "http://a/" and found[2]["digest_algorithm"] == "sha256" and found[2]["payload_bytes"] == len(BODY)
    assert (found[10]["refers_to_uri"], found[10]["refers_to_date"]) == ("http://a/", "2019-01-01T00:00:00Z")
    one_member = member(b"".join(r for _, _, r in FOREIGN))
    assert [r["payload"] for r in warc.read_records(io.BytesIO(one_member))] == [p for _, p, _ in FOREIGN]


BROKEN = [
    member(foreign("response", b"HTTP/1.1 200 OK\r\n\r\n" + BODY, HTTP, WARC_Payload_Digest=digest_field("sha1", b"other", "base32"))),
    member(foreign("resource", BODY, WARC_Block_Digest=digest_field("sha256", b"other", "hex"))),
    member(foreign("resource", BODY, WARC_Block_Digest="sha1:%%%")),
    member(foreign("response", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n" + BODY, HTTP)),
    member(foreign("response", CHUNKED.replace(b"10\r\n", b"zz\r\n"), HTTP)),
    member(foreign("resource", BODY).replace(b"Content-Length", b"Content-Langth")),
    member(foreign("resource", BODY).replace(b"Content-Length: 2", b"Content-Length: 9")),
    member(foreign("resource", BODY) + b"more"),
    member(b"no record at all\r\n\r\n"),
    member(foreign("resource", random.Random(3).randbytes(4000)))[:-900],
    (lambda m: m[:700] + bytes(64) + m[764:])(member(foreign("resource", random.Random(4).randbytes(4000)))),
    b"garbage that is no gzip",
]


@pytest.mark.parametrize("size", [5, 1 << 18])
@pytest.mark.parametrize("broken", range(len(BROKEN)))
def test_damage_costs_one_record_and_is_reported(monkeypatch, broken, size):
    monkeypatch.setattr(warc, "READ_BYTES", size)
    good = [member(r) for _, _, r in FOREIGN]
    for place in (0, 5, len(good)):
        data = b"".join([*good[:place], BROKEN[broken], *good[place:]])
        found = list(warc.read_records(io.BytesIO(data), damaged="report"))
        assert [r["payload"] for r in found if not r["error"]] == [p for _, p, _ in FOREIGN], place
        assert len([r for r in found if r["error"]]) == 1
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(data)))


def test_foreign_archives_as_a_table(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"crawl-{i}.warc.gz").write_bytes(b"".join([*[member(r) for _, _, r in FOREIGN], BROKEN[i]]))
    files = spark.createDataFrame([(f"crawl-{i}.warc.gz",) for i in range(3)], "file string")
    found = warc.read_archives(files, str(tmp_path), damaged="report")
    assert found.count() == 3 * (len(FOREIGN) + 1) and found.where("error is not null").count() == 3
    with pytest.raises(ValueError):
        warc.read_archives(files, str(tmp_path), damaged="ignore")


def test_revisits_name_the_original_in_the_standard_fields(spark):
    pages = spark.createDataFrame([(1, "http://a/1", "x" * 200), (2, "http://a/2", "x" * 200)], "page_id long, url string, html string")
    folder = shared_dir(spark, "test-revisits")
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(warc.records(pages), folder), folder).collect()}
    assert (got[2].record_type, got[2].refers_to, got[2].refers_to_uri, got[2].refers_to_date) == ("revisit", 1, "http://a/1", got[1].date)


# 5: SimHash


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in rows_of("documents")]
    rows += [(100 + r.doc_id, r.text) for r in queries.table(spark, SF_DIR, "documents").limit(150).collect()]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {t: brute_fingerprint(t) for _, t in rows}
    assert Counter((r.doc_id, r.fp % 2**64) for r in found) == Counter((i, prints[t]) for i, t in rows)
    nodes = sorted(set(prints.values()))
    root = unions([(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 2], nodes)
    first = {}
    for i, t in rows:
        if i is not None:
            first[root[prints[t]]] = min(i, first.get(root[prints[t]], i))
    assert all(r.component_id == first.get(root[r.fp % 2**64]) for r in found)


@pytest.mark.parametrize("hot", [2, 256])
@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_against_brute_force(spark, monkeypatch, max_bits, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(max_bits)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1]
    values = sorted({s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for s in seeds for _ in range(12)})
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    found = {(r.a, r.b) for r in simhash.links(keep(spark.createDataFrame([(v,) for v in signed], "fp long"), "test"), max_bits).collect()}
    assert found == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits}


def test_thresholds_sum_as_the_principle_asks():
    rng = np.random.default_rng(0)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(np.int64)
    for n in (500, 10**6, 10**11):
        for k in (0, 1, 2, 3):
            plan = simhash.allocate(n, bits.T @ bits * (n // 500), k)
            assert sum(t + 1 for _, t in plan) == k + 1
            assert len({b for g, _ in plan for b in g}) == sum(len(g) for g, _ in plan)


# 6: embeddings


@pytest.mark.parametrize("block", [8, 1024])
def test_embeddings_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((120, 32))
    near = np.concatenate([b + rng.standard_normal((6, 32)) * s for b, s in zip(base, np.linspace(0.02, 0.4, 120))])
    hot = base[0] + rng.standard_normal((60, 32)) * 0.05
    x = np.concatenate([base, near, hot, hot[:9], rng.standard_normal((200, 32))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=block).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    exact = link.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= exact).all() and found.sum() >= 0.98 * exact.sum()
    root = unions(np.argwhere(link), range(len(x)))
    same = [got[i].component_id == root[i] for i in range(len(x))]
    assert sum(same) >= 0.98 * len(same)
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_embeddings_defined_results(spark, odd_dir):
    rows = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in queries.op6_embeddings(spark, odd_dir).collect()]
    expected = [
        (0, 5, 0, True), (1, 5, 0, False), (1, 5, 0, False), (2, 5, 0, False), (3, 5, 0, False), (None, 5, 0, False),
        *((i, 0, i, True) for i in range(4, 13)),
    ]
    assert Counter(rows) == Counter(expected)


def test_decoding_finds_all_directions_above_the_threshold():
    code = embeddings.Code(24, 50, 0.9)
    x = np.random.default_rng(1).standard_normal((40, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows, filters = code.decode(x)
    sums = [code._sums(parts) for parts in zip(*code.products(x))]
    assert list(zip(rows.tolist(), filters.tolist())) == [(i, int(f)) for i, s in enumerate(sums) for f in np.nonzero(s >= code.threshold)[0]]


# 7: toxicity


def test_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in queries.table(spark, "/root/testdata/sf0.01", "labels").collect()}
    rows = [r for r in queries.op7_toxicity(spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    caught = [r.predicted for r in rows if labels[r.doc_id]]
    wrong = [r.predicted for r in rows if not labels[r.doc_id]]
    assert sum(caught) >= 0.6 * len(caught) and sum(wrong) <= 0.02 * len(wrong)


def test_counterfactual_penalty_frees_names_of_groups(spark):
    rng = random.Random(5)
    filler = [f"filler{i}" for i in range(50)]
    docs, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = rng.sample(filler, 8) + (["muslims"] if rng.random() < (0.7 if toxic else 0.05) else []) + (["idiot"] if toxic and rng.random() < 0.9 else [])
        docs.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    free, held = toxicity.train(docs, labels, penalty=0.0), toxicity.train(docs, labels)

    def gap(model):
        return abs(model.score("the muslims met today.") - model.score("the christians met today."))

    assert gap(free) > 0.2 and gap(held) < 0.2 * gap(free)
    assert held.score("what an idiot he is") > 0.7


def test_swapped_sentences_come_from_the_whole_text():
    sentences = [f"number {i} says the women met" for i in range(200)]
    found = toxicity.swaps(". ".join(sentences))
    places = {int(words[1]) for words, _ in found}
    assert len(found) == toxicity.MAX_SWAPS_DOC and len(places) == toxicity.MAX_SWAPS_DOC // 2 and max(places) >= 4
    assert toxicity.swaps(". ".join(reversed(sentences))) == found
    assert len(toxicity.swaps("The women met. Nobody else. The women met. The men left.")) == 4


def test_bounds_and_names_are_arguments(spark):
    docs = spark.createDataFrame([(i, f"the zorks met. filler{i % 7} {'bad' if i % 2 else 'good'}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels).pairs == 0
    named = toxicity.train(docs, labels, identity=(("", "zorks", "florps"),), max_swaps=20, max_features=3)
    assert named.pairs == 20 and len(named.weights) <= 5
    assert toxicity.swaps("The zorks met.", 2, (("", "zorks", "florps"),)) == [(["the", "zorks", "met"], ["the", "florps", "met"]), (["the", "zorks", "met"], ["the", "met"])]


def test_labels_of_held_out_rows_are_never_used(spark, odd_dir):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert a.weights == b.weights and a.bias == b.bias


# 8: decontamination


@pytest.mark.parametrize("seed", range(4))
def test_search_against_brute_force(seed):
    rng = random.Random(seed)
    alphabet = [b"a", b"b", b"c"][: 2 + seed % 2]
    items = [(str(k), b" ".join(rng.choices(alphabet, k=rng.randrange(0, 9)))) for k in range(12)] + [(None, b"c c c")]
    tables = decontaminate.build(items, 4)
    for _ in range(60):
        text = rng.choices(alphabet, k=rng.randrange(0, 30))
        marks, ids = set(), set()
        for item, t in items:
            w = t.split()
            n = min(4, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                for j in range(len(text) - n + 1):
                    if text[j:j + n] == w[i:i + n]:
                        marks.update(range(j, j + n))
                        ids.update([item] if item else [])
        spans, found = decontaminate.find(text, tables)
        assert {x for a, b in spans for x in range(a, b)} == marks and found == ids


def test_search_tables_stay_small_and_exact():
    """A large benchmark of few words: many windows share a suffix, and every length occurs."""
    rng = random.Random(2)
    items = [(str(k), b" ".join(rng.choices([b"the", b"of", b"a", b"to", b"in"], k=rng.randrange(1, 60)))) for k in range(300)]
    tables = decontaminate.build(items, 10)
    held = sum(a.nbytes for t in tables.patterns for a in (t.blocks, t.shift, t.tails, t.starts)) + tables.text.nbytes
    assert held < 40 * len(tables.text) + 4096
    grams = {}
    for item, t in items:
        w = t.split()
        n = min(10, len(w))
        for i in range(len(w) - n + 1):
            grams.setdefault(tuple(w[i:i + n]), set()).add(item)
    for _ in range(20):
        text = rng.choices([b"the", b"of", b"a", b"to", b"in", b"new"], weights=[9, 9, 9, 9, 9, 1], k=200)
        marks, ids = set(), set()
        for n in {len(g) for g in grams}:
            for j in range(len(text) - n + 1):
                if found := grams.get(tuple(text[j:j + n])):
                    marks.update(range(j, j + n))
                    ids |= found
        spans, found = decontaminate.find(text, tables)
        assert {x for a, b in spans for x in range(a, b)} == marks and found == ids


def test_shards_agree_with_one_search(spark, odd_dir):
    docs, items = queries.table(spark, odd_dir, "documents"), queries.table(spark, SF_DIR, "benchmark").select("item_id", "text").union(
        spark.createDataFrame([(r[0], r[1]) for r in rows_of("benchmark")], "item_id long, text string")
    )
    one = sorted(map(str, decontaminate.report(docs, items).collect()))
    many = decontaminate.search(docs, items, shard_bytes=2000).select("found")
    assert sorted(str(r.found["items"]) for r in many.collect()) == sorted(str(r.found["items"]) for r in decontaminate.search(docs, items).select("found").collect())
    assert any("contaminated=True" in r for r in one)


# 9: tokens


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_and_cache(spark, odd_dir, name):
    path, cache = queries.tokenizer_path(name), shared_dir(spark, "test-cache")
    docs = queries.table(spark, odd_dir, "documents")
    count = tokens._load(path)
    expected = Counter((r[0], len((r[1] or "").encode()), count([r[1] or ""])[0]) for r in rows_of("documents"))
    for _ in range(2):
        assert Counter(map(tuple, tokens.count_tokens(docs, path, cache).collect())) == expected
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r[1] or "" for r in rows_of("documents")})
    # A miss alone is encoded, and a stored count is believed.
    stored.withColumn("n_tokens", F.lit(7).cast("long")).write.parquet(f"{cache}-other")
    again = tokens.count_tokens(docs.unionByName(docs.limit(1).withColumn("text", F.lit("new text"))), path, f"{cache}-other")
    assert Counter(r.n_tokens == 7 for r in again.collect()) == {True: len(rows_of("documents")), False: 1}
