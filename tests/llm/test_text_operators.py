"""Text operators against brute force, on edges: null, empty and long texts, ties, repeated rows, empty tables."""

import collections
import hashlib
import random
import re
import re._parser as sre
import struct
import zlib

import public_tokenizers
import pyarrow as pa
import pytest

from tidelog.llm import jaccard, licenses, ogg, personal_data, pieces, queries, token_counts

ODD = [(1, "Hello world. don't 'tis  x", "clash"), (2, None, "clash"), (3, "", None), (None, "no id", "x"), (5, " \n\t ", "x"), (1, "Hello world. don't 'tis  x", "clash"), (7, "é中🙂 <|endoftext|> ﬁ", "x"), (8, "ab " * 50_000, "x"), (9, "z" * 200_000, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, n_bytes string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_bytes string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def texts(n, parts, seed=1, most=12):
    r = random.Random(seed)
    return ["".join(r.choice(parts) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_token_counts(odd, none, spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    count = lambda t: len(lib.encode(t, add_special_tokens=False))
    want = sorted(((d, len((t or "").encode()), n := count(t or ""), n > 1024) for d, t, _ in ODD), key=str)
    assert rows(token_counts.count_tokens(odd, path)) == want
    assert rows(token_counts.count_tokens(none, path)) == []
    parts = ["a", "s", "t", "re", "'", "''", " ", "  ", "\n", "1", "!", "é", "²", " ", "　", "中", "<|endoftext|>", "՘", "\r\n", "S", "🙂", "_", "'ll", "x" * 70]
    some = texts(1500, parts)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(some)], "doc_id long, text string").repartition(3)
    want = [(k, len(t.encode()), n := count(t), n > 1024) for k, t in enumerate(some)]
    for common in (token_counts.COMMON, 40, 0):  # the whole table, its most frequent rows and none go to the workers
        assert sorted(tuple(r) for r in token_counts.count_tokens(docs, path, common=common).collect()) == want
    own = token_counts.Counter(path)
    table = {r.pre_token: (r.n, r.pieces) for r in token_counts.table(docs, path).collect()}
    seen = collections.Counter(x for t in some if (c := own.cut(column([t]))) for x in (c.some[k].decode() for k in c.where.tolist()))
    assert table == {t: (n, count(t)) for t, n in seen.items() if len(t.encode()) <= token_counts.LONG}
    assert rows(token_counts.frequencies(docs, path, held=3)) == rows(token_counts.frequencies(docs, path))


def complements(n):
    """Two words of n letters whose polynomials modulo 2^64 are equal, whatever the base."""
    a = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_long_words_that_polynomial_hashes_confuse(spark):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    some = []
    for n in (1024, 2048, 4096, 8192):
        a, b = complements(n)
        some += [a, b, f"one {a} two", f"one {b} two", f"{a} {b}", " ".join(f"{a}{k}" for k in range(6)), " ".join(f"{b}{k}" for k in range(6))]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").coalesce(1)
    lib, path = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.path("byte_bpe_50k.json")
    assert [r.n_tokens for r in token_counts.count_tokens(docs, path).orderBy("doc_id").collect()] == [len(lib.encode(t)) for t in some]
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib, sha = SentencePieceProcessor(model_file=path), lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(sha(",".join(map(str, i))), sha(lib.decode(i))) for i in lib.encode(some)]
    assert [(r.ids_sha256, r.decoded_sha256) for r in pieces.round_trip(docs, path).orderBy("doc_id").collect()] == want
    joined = jaccard.join(docs, n=4, percent=85).collect()
    assert sorted((r.doc_id, r.component_id) for r in joined) == [(k, k) for k in range(len(some))]


def column(some):
    return pa.array(some, pa.large_string())


def encoded(own, some):
    """Ids and spans of each text."""
    ids, begins, ends, first = own.encode(column(some))
    both = list(zip(begins.tolist(), ends.tolist(), strict=True))
    return [(ids.to_pylist()[i:j], both[i:j]) for i, j in zip(first.tolist(), first[1:].tolist(), strict=False)]


def test_pieces(odd, none):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    lib, own = SentencePieceProcessor(model_file=path), pieces.Codec(open(path, "rb").read(), dictionary=300)
    parts = ["a", "the", " ", "  ", "\n", "\t", "▁", "é", "中", "🙂", "<s>", "<0x0A>", "don't", ".", "..", ",", "1", "\x00", "<unk>"]
    some = texts(1500, parts)
    got = [x for i in range(0, len(some), 25) for x in encoded(own, some[i : i + 25])]
    assert [ids for ids, _ in got] == lib.encode(some)
    for t, (ids, spans) in zip(some, got, strict=True):
        b = t.encode()
        assert own.decode(ids) == lib.decode(ids)
        assert b"".join(b[x:y] for x, y in spans) == b  # the spans rebuild the text
        said = lib.encode(t, return_type="proto").pieces
        assert [s for s, i in zip(spans, ids, strict=True) if own.kinds[i] != pieces.BYTE] == [(p.begin, p.end) for p in said if own.kinds[p.id] != pieces.BYTE]
    sha = lambda s: hashlib.sha256(s).hexdigest()
    want = []
    for d, t, _ in ODD:
        i = lib.encode(t or "")
        spans = encoded(own, [t or ""])[0][1]
        want.append((d, len(i), sha(",".join(map(str, i)).encode()), sha(lib.decode(i).encode()), sha(struct.pack(f"<{2 * len(spans)}q", *(x for s in spans for x in s)))))
    assert rows(pieces.round_trip(odd, path)) == sorted(want, key=str)
    assert rows(pieces.round_trip(none, path)) == rows(pieces.encode(none, path)) == []
    first = pieces.encode(odd.where("doc_id = 7"), path).first()
    assert first.ids == lib.encode(ODD[6][1]) and first.ends[-1] == len(ODD[6][1].encode()) and first.begins[0] == 0


def brute_normal(own, text):
    """Character by character: the normalised text, and the source of each of its bytes."""
    b, out, i = text.encode(), [], 0
    while i < len(b):
        hit = own.map.longest(b, i, len(b)) if own.map.units else None
        n, to = hit or ((k := 1 if b[i] < 0x80 else 2 if b[i] < 0xE0 else 3 if b[i] < 0xF0 else 4), b[i : i + k])
        whole = hit is not None
        out += [(c, i if whole or c == " " else None, i + n) for c in to.decode()]
        i += n
    if own.squeeze:
        out = [x for k, x in enumerate(out) if x[0] != " " or k and out[k - 1][0] != " "]
        while out and out[-1][0] in " ▁":
            out.pop()
    spans = [(s, e) if s is not None else (e - len(c.encode()) + k, e - len(c.encode()) + k + 1) for c, s, e in out for k in range(len(pieces.MARK if c == " " else c.encode()))]
    normal = "".join(c for c, *_ in out).replace(" ", "▁")
    return ("▁" + normal, [(spans[0][0],) * 2] * 3 + spans) if own.prefix and normal else (normal, spans)


def test_character_map_equals_the_library():
    from sentencepiece import SentencePieceNormalizer

    for rule, prefix, squeeze in (("nmt_nfkc", True, True), ("nfkc", False, False), ("nmt_nfkc_cf", True, False), ("identity", True, True)):
        lib = SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze, escape_whitespaces=True)
        spec = {k: v for f, v, _ in pieces.fields(lib.serialized_model_proto()) if f == 3 for k, v, _ in pieces.fields(v)}
        own = pieces.Codec.__new__(pieces.Codec)
        own.map, own.prefix, own.squeeze = pieces.CharacterMap(spec.get(2, b"")), prefix, squeeze
        own.key_starts = own.map.starts()
        some = texts(800, ["a", "A", " ", "  ", "①", "ﬁ", "ｱﾞ", "Ⅷ", "℃", "​", "　", "Å", "é", "\n", "中", "▁"])
        for i in range(0, len(some), 40):
            got = own.normalise(column(some[i : i + 40]))
            for k, t in enumerate(some[i : i + 40]):
                x, y = int(got.at[k]), int(got.at[k + 1])
                normal, spans = brute_normal(own, t)
                assert got.data[x:y].tobytes().decode() == normal == lib.normalize(t), (rule, t)
                assert [(a - got.source_at[k], b - got.source_at[k]) for a, b in zip(got.begin[x:y].tolist(), got.end[x:y].tolist(), strict=True)] == spans, (rule, t)


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(d := digits(m[0])) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]


def test_personal_data(odd, none, spark):
    parts = ["a", "b.", "@", "x.com", ".", "-", " ", "1", "23", "255", "256.", "0", "+", "+1", "(", ")", "4111 1111 1111 1111", "4111111111111111", "é", "192.168.0.1", "%", "joe@x.org", "+49 30 1234567"]
    for t in texts(6000, parts):
        assert [tuple(s[:3]) for s in personal_data.find(t) if s.kind in personal_data.BASE] == base_spans(t)
    t = "My IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789; 123-45-6789 " + "-" * 80 + " 123-45-6789"
    assert [s.kind for s in personal_data.find(t)] == ["iban", "ssn", "ssn"]
    assert not [s for s in personal_data.find("DE89 3704 0044 0532 0130 01") if s.kind == "iban"]
    docs = spark.createDataFrame([(1, "mail joe@x.org or 10.0.0.1", 26, "keep"), (2, None, None, "keep"), (3, "clean", 99, None)], "doc_id long, text string, n_chars long, spans string")
    digest = personal_data.digests(docs).orderBy("doc_id").collect()
    assert (digest[0].n_email, digest[0].n_ip, digest[0].spans) == (1, 1, "email:5:14,ip:18:26") and digest[0].base_sha256 == hashlib.sha256(b"email:5:14,ip:18:26").hexdigest()
    assert rows(personal_data.redacted(docs)) == [(1, "mail <EMAIL> or <IP>", 20, "keep"), (2, None, None, "keep"), (3, "clean", 99, None)]
    assert personal_data.digests(odd).count() == len(ODD) and rows(personal_data.digests(none)) == rows(personal_data.redacted(none)) == []
    scored = {t: [(s.kind, s.score) for s in personal_data.find(t)] for t in ("host 10.0.0.1", "at 10.0.0.1", "version 10.0.0.1", "id 123-45-6789", "ssn 123-45-6789")}
    assert scored == {"host 10.0.0.1": [("ip", 0.9)], "at 10.0.0.1": [("ip", 0.6)], "version 10.0.0.1": [("ip", 0.1)], "id 123-45-6789": [], "ssn 123-45-6789": [("ssn", 0.6)]}
    kept = spark.createDataFrame([(k, t) for k, t in enumerate(scored)], "doc_id long, text string")
    assert [r.text for r in personal_data.redacted(kept).orderBy("doc_id").collect()] == ["host <IP>", "at <IP>", "version 10.0.0.1", "id 123-45-6789", "ssn <SSN>"]
    assert [r.scores for r in personal_data.digests(kept).orderBy("doc_id").collect()] == ["0.90", "0.60", "0.10", "", "0.60"]
    personal_data.find("1" * 300_000 + "@" + "a." * 1000 + "@" * 1000 + "+1" + " " * 100_000)


def test_licenses(odd, none, spark):
    def brute(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        at = [(i, label) for p, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")) for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        where = [i for i, _ in at]
        return len(w), len(at), min(where, default=None), max(where, default=None), ",".join(sorted({x for _, x in at}))

    parts = ["under ", "the ", "MIT-", "License ", "apache ", "version ", "2", ".0 ", "CC ", "by", "-NC ", "é", "\n", "x ", "under the mit license "]
    some = list(enumerate(texts(400, parts, most=20))) + [(d, t) for d, t, _ in ODD]
    got = licenses.scan(spark.createDataFrame(some, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got if r.doc_id is not None) == sorted((d, *brute(t)) for d, t in some if d is not None)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert rows(licenses.scan(none)) == [] and licenses.scan(odd).count() == len(ODD)
    joined = lambda t: b" " + b" ".join(licenses._WORD.findall(t.lower().encode())) + b" "
    labels = lambda t: sorted({d.label for d in licenses.detect(joined(t))})
    assert labels("GNU Lesser General Public License, version 3") == ["lgpl-3"]
    assert labels("SPDX-License-Identifier: GPL-2-only") == ["gpl-2"] and labels("Creative Commons Attribution-ShareAlike 4.0") == ["cc-by-sa"]
    assert len({r.pattern.pattern for r in licenses.RULES}) == len(licenses.RULES) > 350 and [r.priority for r in licenses.RULES] == sorted((r.priority for r in licenses.RULES), reverse=True)


def test_license_detections_equal_brute_force():
    """All rules without gate and keywords, and every pair of detections for containment."""
    r = random.Random(4)
    some = [t for block in (licenses.FAMILIES, licenses.NOTICES) for row in block.strip().split("\n") for t in phrases(row.split(" ; ")[1])[:4]]
    some += ["spdx license identifier " + t for row in licenses.IDENTIFIERS.strip().split("\n") for t in phrases(row.split(" ; ")[1])]
    for _ in range(300):
        text = " ".join(r.choice(some) if r.random() < 0.7 else r.choice(["the", "x 2 0", "license", "under", "and", "version"]) for _ in range(r.randint(1, 8)))
        joined = f" {text} ".encode()
        found = [licenses.Detection(x.label, m.start(), m.end(), x.priority, x.score) for x in licenses.RULES for m in x.pattern.finditer(joined)]
        inside = lambda a, b: b.start <= a.start and a.end <= b.end and b.priority >= a.priority
        kept = [a for k, a in enumerate(found) if not any(inside(a, b) and ((b.start, b.end, b.priority) != (a.start, a.end, a.priority) or n < k) for n, b in enumerate(found) if n != k)]
        assert sorted(licenses.detect(joined)) == sorted(kept), text
        assert licenses._GATE.search(text.encode()) or not found, text


def test_ibans_before_upper_case_words():
    ibans = lambda t: [t[s.start : s.end] for s in personal_data.find(t) if s.kind == "iban"]
    known = ["ES9121000418450200051332", "AT611904300234573201", "PL61109010140000071219812874", "BE68539007547034", "HU42117730161111101800000000", "DE89370400440532013000", "NO9386011117947", "MT84MALT011000012345MTLCAST001S"]
    for iban in known:
        grouped = " ".join(iban[i : i + 4] for i in range(0, len(iban), 4))
        for form in (iban, grouped):
            for after in ("", ",", " EUR", " BIC", " PLN 12", " A", " EURO", " SWIFT CODE", " EUR.", " eur"):
                assert ibans(f"to {form}{after}") == [form], (form, after)
            assert ibans(f"{form} BE71 0961 2345 6769 EUR") == [form, "BE71 0961 2345 6769"]
            assert ibans(f"AB12 CDEF GHIJ {form} EUR") == [form]
        wrong = iban[:-1] + ("1" if iban[-1] != "1" else "2")
        assert ibans(f"{wrong} EUR") == []
    t = "pay AT611904300234573201 EUR 5"
    assert personal_data.redact(t, personal_data.find(t)) == "pay <IBAN> EUR 5"
    personal_data.find("AB12 CDEF GHIJ " * 20_000)


def phrases(pattern):
    """Texts that a pattern matches: each alternative and optional part is taken at least once, classes by their first character."""

    def of(parsed):
        out = [""]
        for op, arg in parsed:
            if op is sre.LITERAL:
                some = [chr(arg)]
            elif op is sre.IN:
                some = [chr(x if kind is sre.LITERAL else x[0]) for kind, x in arg[:1]]
            elif op is sre.SUBPATTERN:
                some = of(arg[3])
            elif op is sre.BRANCH:
                some = [x for branch in arg[1] for x in of(branch)]
            else:
                assert op is sre.MAX_REPEAT, op
                inner = of(arg[2])
                some = [*([""] if not arg[0] else []), *(x * max(1, arg[0]) for x in inner)]
            out = [a + b for a in out for b in some]
        return out

    return of(sre.parse(pattern))


def test_every_license_alternative_is_found_alone(spark):
    rows = [(label, p) for block in (licenses.FAMILIES, licenses.NOTICES) for row in block.strip().split("\n") for label, p in [(row.split(" ; ")[0], row.split(" ; ")[-1])]]
    rows += [(row.split(" ; ")[0], "spdx license identifier " + row.split(" ; ")[1]) for row in licenses.IDENTIFIERS.strip().split("\n")]
    want = [(k, f"zz {t.upper()} zz", label) for k, (label, t) in enumerate((label, t) for label, p in rows for t in phrases(p))]
    assert len(want) > 400 and len({label for label, _ in rows} - {label for *_, label in want}) == 0
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(spark.createDataFrame([w[:2] for w in want], "doc_id long, text string")).collect()}
    assert not [(text, label, got[k]) for k, text, label in want if label not in got[k]]
    for text, label in (("GNU GPL v3", "gpl-3"), ("gnu gpl 2", "gpl-2"), ("without prior written permission", "proprietary"), ("without the prior written consent", "proprietary"), ("PSF License", "psf-2"), ("Internet Systems Consortium License", "isc"), ("PNG Reference Library License", "libpng"), ("do what the fuck you want to public license", "wtfpl"), ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", "bsl-1")):
        assert label in {d.label for d in licenses.detect(b" " + b" ".join(licenses._WORD.findall(text.lower().encode())) + b" ")}, text
    for r in licenses.RULES:
        assert all(r.keyword in t.encode() for t in phrases(r.pattern.pattern.decode().replace("(?= )", ""))), r


def test_ogg(odd, none):
    rng = random.Random(3)
    for n in (0, 1, 63, 64, 254 * 64, 255 * 64, 4000, 255 * 255, 300_000):
        payload = ogg.pad(rng.randbytes(n))
        stored = ogg.write(payload)
        assert len(payload) % 64 == 0 and payload and ogg.payload_of(ogg.read(stored))[0] == payload
        # each packet begins where the one before it ends, and holds its own samples
        times = ogg.payload_of(ogg.read(stored))[1]
        assert times == [(i / ogg.RATE, min(i + ogg.PACKET, len(payload)) / ogg.RATE) for i in range(0, len(payload), ogg.PACKET)]
        for at in {0, 26, len(stored) // 2, len(stored) - 1}:
            with pytest.raises(ogg.Damaged):
                bad = bytearray(stored)
                bad[at] ^= 1
                ogg.payload_of(ogg.read(bytes(bad)))

    def slow(b):
        r = 0
        for x in b:
            r ^= x << 24
            for _ in range(8):
                r = ((r << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if r >> 31 else (r << 1) & 0xFFFFFFFF
        return r

    assert all(ogg.page_crc(b) == slow(b) for b in (b"", b"a", b"hello world", bytes(range(256))))
    got = {r.doc_id: r for r in ogg.from_ogg(ogg.to_ogg(odd)).collect()}
    for d, t, _ in ODD:
        payload = ogg.pad((t or "").encode())
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        x = [v - 128 for v in payload]
        loud = max(range(0, len(x), ogg.PACKET), key=lambda i: (sum(v * v for v in x[i : i + ogg.PACKET]) / len(x[i : i + ogg.PACKET]), -i))
        assert r.error is None and r.feature.endswith(f";packets={-(-len(x) // ogg.PACKET)};loudest={loud / ogg.RATE:.6f}")
    assert rows(ogg.from_ogg(ogg.to_ogg(none))) == []


def test_ogg_null_and_damaged_media(spark):
    good = ogg.write(ogg.pad(b"abc"))
    # a wrong position under a right checksum: the last page of the sound stream says one sample more
    at = good.rindex(b"OggS")
    moved = bytearray(good[at:])
    moved[6:14] = struct.pack("<q", 65)
    moved[22:26] = bytes(4)
    moved[22:26] = ogg.page_crc(bytes(moved)).to_bytes(4, "little")
    media = [(1, good), (2, None), (3, good[:-1]), (4, b""), (5, b"OggS"), (6, good[:40] + b"x" + good[41:]), (7, good[:at] + bytes(moved)), (8, good)]
    got = {r.doc_id: r for r in ogg.from_ogg(spark.createDataFrame([(d, 3, m) for d, m in media], "doc_id long, n_bytes long, media binary").coalesce(1)).collect()}
    assert len(got) == len(media) and got[1][1:] == got[8][1:] and got[1].error is None and got[1].payload_bytes == 64
    assert got[2].error is None and got[2].media_bytes is None and all(got[d].error and got[d].payload_sha256 is None and got[d].media_bytes is not None for d in (3, 4, 5, 6, 7))
    assert "positions" in got[7].error


def test_queries_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 11))
