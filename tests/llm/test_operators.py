"""Every operator on hard rows against brute force, and on empty and clashing tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    decontaminate,
    mixing,
    packed,
    pseudonyms,
    quality,
    recompress,
    registry,
    simhash,
    substrings,
    suffixes,
    token_counts,
    urls,
)
from tidemark.llm.components import components
from tidemark.llm.vocab import public_vocabulary, word_encoder

from llm.conftest import LONG, ROWS


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


# ---- quality rules


def brute_quality(text):
    w, body = words(text), text or ""
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {g for g in set(grams) if grams.count(g) > 1} if len(grams) < 2000 else {g for g in set(grams)}
    repeat = len({i + k for i, g in enumerate(grams) if g in twice for k in range(3)})
    lines = [x for x in body.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", body)), len(lines) - len(set(lines)), repeat


def test_quality_measures_equal_brute_force(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = rows(quality.ledger(docs), "doc_id", *names)
    assert got == sorted(((r[0], *brute_quality(r[1])) for r in ROWS), key=str)


def test_quality_repeats_on_random_texts(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(rows(quality.ledger(df), "doc_id", "n_repeat_words"))
    assert got == {i: brute_quality(t)[4] for i, t in enumerate(texts)}


def test_ablation_reads_bits_only(docs):
    ledger = quality.ledger(docs)
    bits = [r[0] for r in ledger.select("fail_bits").collect()]
    mask = quality.mask(quality.POLICIES["v1"])
    for r in quality.ablation(ledger).where("policy = 'v1'").collect():
        bit = next(1 << x.bit for x in quality.RULES if x.name == r["rule"])
        assert r["kept"] == sum(b & mask == 0 for b in bits)
        assert r["failing"] == sum(b & bit != 0 for b in bits)
        assert r["only_this_rule"] == sum(b & mask == bit for b in bits)


# ---- SimHash


def brute_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids = {i: p for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (ids[i] ^ ids[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in ids]


def test_fingerprints_equal_brute_force():
    for text in [None, "", "a", "A b", LONG, LONG.upper(), "É x y z", *(r[1] for r in ROWS if len(r[1] or "") < 9000)]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks()
    assert len(masks) == 7 and {m.bit_count() for m in masks} <= {36, 37}
    for a in range(64):
        for b in range(64):
            assert any(not (1 << a | 1 << b) & m for m in masks)


def test_links_join_exactly_the_near_fingerprints(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = {s ^ sum(1 << rng.randrange(64) for _ in range(k)) & (1 << 64) - 1 for s in seeds for k in (0, 1, 1, 2, 3, 4) for _ in range(2)}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    rooted = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
    got = [rooted.get(simhash.signed(p), simhash.signed(p)) for p in prints]
    want = brute_components(prints)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_simhash_query_on_hard_rows(docs):
    got = rows(simhash.near_duplicates(docs), "doc_id", "component_id")
    groups = brute_components([brute_fingerprint(r[1]) if len(r[1] or "") < 9000 else simhash.fingerprint(r[1]) for r in ROWS])
    least = {}
    for r, g in zip(ROWS, groups, strict=True):
        least[g] = min((x for x in (least.get(g), r[0]) if x is not None), default=None)
    assert got == sorted(((r[0], least[g]) for r, g in zip(ROWS, groups, strict=True)), key=str)


def test_one_document_per_group_stays(docs):
    kept = [r["doc_id"] for r in simhash.deduplicated(docs).collect()]
    groups = brute_components([brute_fingerprint(r[1]) if len(r[1] or "") < 9000 else simhash.fingerprint(r[1]) for r in ROWS])
    first = {}
    for r, g in zip(ROWS, groups, strict=True):
        first[g] = min(first.get(g, r[0]), r[0], key=lambda x: (x is None, x or 0))
    assert sorted(kept, key=str) == sorted(first.values(), key=str)


def test_copies_without_ids_are_one_group(spark):
    data = [(None, LONG), (None, LONG), (None, LONG.upper()), (None, LONG[::-1]), (None, None), (None, "")]
    for order in (data, data[::-1]):
        got = rows(simhash.deduplicated(spark.createDataFrame(order, "doc_id long, text string").repartition(3)), "text")
        assert len(got) == 3 and (LONG[::-1],) in got and len({(t or "").lower() for (t,) in got}) == 3


def test_repeated_ids_are_decided_by_text(spark):
    base = [f"q{i}z" for i in range(300)]
    variants = (" ".join([*base[:k], "other", *base[k + 1 :]]) for k in range(300))
    b = " ".join(base)
    near = next(v for v in variants if 0 < (simhash.fingerprint(v) ^ simhash.fingerprint(b)).bit_count() <= 2)
    a, c, d = ("alpha " + LONG[::-1], "gamma " + LONG, "delta " + b[::-1])
    data = [(5, a), (5, b), (3, near), (6, c), (6, d), (6, d.upper()), (6, d), (None, b)]
    want = sorted([(5, a), (3, near), (6, c)], key=str)
    kept = []
    for order in (data, data[::-1]):
        got = rows(simhash.deduplicated(spark.createDataFrame(order, "doc_id long, text string").repartition(3)), "doc_id", "text")
        kept += [r for r in got if r[1].lower() == d.lower()]
        assert [r for r in got if r[1].lower() != d.lower()] == want
    assert len(kept) == 2 and kept[0] == kept[1] and kept[0][0] == 6


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


# ---- decontamination


def test_leaks_in_long_documents_are_found(spark):
    item = " ".join(f"q{i}" for i in range(40))
    near = " ".join("XX" if i == 20 else f"q{i}" for i in range(40))  # 31 of 36 shingles
    far = " ".join("XX" if i in (12, 28) else f"q{i}" for i in range(40))  # 26 of 36
    texts = [(1, LONG + " " + item.upper() + ", " + LONG), (2, LONG + near), (3, near + " " + LONG), (4, far), (5, None), (6, ""), (7, "tiny item"), (None, item), (8, "Tiny, ITEM!"), (9, item), (9, item)]
    items = [(10, item), (11, "tiny item"), (12, None), (13, ""), (None, item)]
    got = rows(
        decontaminate.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")),
        "doc_id", "item_id", "shared_shingles",
    )
    held = [(1, 36), (2, 30), (3, 31), (9, 36), (None, 36)]
    assert got == sorted([*((d, i, n) for d, n in held for i in (10, None)), (7, 11, 1), (8, 11, 1)], key=str)


def test_texts_that_share_an_id_are_searched_each_for_itself(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "qr")
    half = two.split()
    texts = [(1, LONG + " " + one), (2, " ".join(half[:20])), (2, " ".join(half[20:])), (3, two), (3, LONG), (None, one), (None, LONG)]
    docs = spark.createDataFrame([(*t, "clash", "clash") for t in texts], "doc_id long, text string, row string, doc_key string")
    items = spark.createDataFrame([(7, one), (7, two)], "item_id long, text string")
    assert rows(decontaminate.find_leaks(docs, items), "doc_id", "item_id") == [(1, 7), (3, 7), (None, 7)]
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id", "text") == sorted([(2, texts[1][1]), (2, texts[2][1]), (3, LONG), (None, LONG)], key=str)


# ---- URL filters


def test_urls(spark):
    cases = [
        ("http://EXAMPLE.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        ("https://a.example.org/en/17?x#y", "a.example.org", "/en/17", "example.org/en/1", "block"),
        ("https://a.example.org/en/2", "a.example.org", "/en/2", "org/", "allow"),
        ("http://casino-win.example.net/en/1", "casino-win.example.net", "/en/1", None, "block"),
        ("http://notcom.net", "notcom.net", "", None, "allow"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://x.com/de/?a", "x.com", "/de/", "com/de/", "block"),
        ("no scheme.org/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://b.net/?xAFF_ID=1&aff_id=22", "b.net", "/", None, "block"),
    ]
    df = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(df).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}


def test_rules_are_filed_under_their_rarest_token():
    index = urls.rarest_token_index(urls.PATTERN_RULES, {"adult": 5, "x": 2, "cheap": 1, "pills": 9})
    assert index["x"] == [2] and index["cheap"] == [3] and index[""] == [4]


# ---- pseudonyms


def test_feistel_is_a_permutation():
    for size in (1, 2, 10, 97, 1000):
        values = [pseudonyms.feistel(i, size, "k", "t") for i in range(size)]
        assert sorted(values) == list(range(size))
        assert [pseudonyms.feistel(v, size, "k", "t", True) for v in values] == list(range(size))


def test_values_keep_format_link_and_come_back(docs):
    text = (
        "card 4432507379035540 and 4432 5073 7903 5540, bad 4432507379035541, iban DE89 3704 0044 0532 0130 00 "
        "ssn 123-45-6789 ip 10.0.0.255 not 300.1.1.1 date 2024-02-29, 31/12/1999, 05.03.2001, not 2023-02-30 "
        "tel +1 (293) 555-9179 mail john.doe99@mail.example.com"
    )
    new, spans = pseudonyms.pseudonymised(text)
    assert pseudonyms.pseudonymised(new, back=True)[0] == text
    assert [k for k, _, _ in spans] == ["card", "card", "iban", "social", "address", "date", "date", "date", "phone", "email"]
    values = [new[a:b] for _, a, b in spans]
    assert values[0] == values[1].replace(" ", "") and pseudonyms.luhn_sum(values[0]) % 10 == 0
    assert pseudonyms._iban_rest(values[2].replace(" ", "")) == 1
    for kept in ("4432507379035541", "300.1.1.1", "2023-02-30"):
        assert kept in new
    got = {(r["doc_id"], r["text"]) for r in pseudonyms.with_pseudonyms(docs).collect()}
    assert (3, None) in got and (4, "") in got and len(got) == len({(r[0], r[1]) for r in ROWS})


def test_neighbours_do_not_hide_values():
    card, plain = "4111 1111 1111 1111", "4111111111111111"
    fresh = pseudonyms.pseudonymised(card)[0]
    for text in ("{} 12/26", "{} 123", "ref 7 {}", "1234 {} 05 27 99", "0 1 2 {} 2024-02-30", "AB12 {}", "666-12-3456 {}"):
        new, spans = pseudonyms.pseudonymised(text.format(card))
        assert fresh in new and "card" in [k for k, _, _ in spans], text
        assert pseudonyms.restored(new, spans) == text.format(card)
        assert fresh.replace(" ", "") in pseudonyms.pseudonymised(text.format(plain))[0], text
    for iban, more in (("BE68 5390 0754 7034", " AND"), ("ES91 2100 0418 4502 0005 1332", " OK"), ("GB82 WEST 1234 5698 7654 32", " 7")):
        assert pseudonyms.pseudonymised(iban + more)[0] == pseudonyms.pseudonymised(iban)[0] + more
        assert pseudonyms.pseudonymised(iban)[0] != iban
    for kept in ("4432 5073 7903 5541", "BE69 5390 0754 7034", "300.100.200.123"):
        assert pseudonyms.pseudonymised(kept) == (kept, [])
    new, spans = pseudonyms.pseudonymised("call 020 7946 0958 1234")  # a card's shape, a telephone number's start
    assert [k for k, _, _ in spans] == ["phone"] and new.endswith(" 1234")


def test_secrets_of_either_case_are_linked():
    secret = "9233a8ec" * 4
    lower, upper = (pseudonyms.pseudonymised(f'TOKEN = "{s}"')[0] for s in (secret, secret.upper()))
    assert lower != f'TOKEN = "{secret}"' and upper == lower.upper()
    assert pseudonyms.pseudonymised(upper, back=True)[0] == f'TOKEN = "{secret.upper()}"'


# ---- token files


def tokens(text, end):
    ids = word_encoder(public_vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids
    return [*ids, end]


def ordered():
    return sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_encoder_equals_the_tokenizer():
    odd = ["á ́b", "<|endoftext|> a<|startoftext|>b don't it's 'S we'LL", "İstanbul ΣΑΣ", "日本語 12 3.4", "\x1c\x1d q\x85r", "é\ń", "ﬁne ½ Ⅷ", "🙂🙂 a‍b", "가 ᅡᆨ", "x y z’s"]
    encoder = word_encoder(public_vocabulary())
    for text in odd:
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint32)
    data = packed.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (packed.unpack(data, bits, 1001) == ids).all()


def test_packed_files_give_back_every_document(docs):
    got = packed.read_packed(packed.write_packed(docs)).collect()
    start, want = 0, []
    for doc, text, *_ in ordered():
        ids = tokens(text, 1)
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_packed_random_access(tmp_path):
    ids = np.arange(40_000, dtype=np.uint32)
    with open(tmp_path / "x", "wb") as out:
        writer = packed.Writer(out, 16)
        for k in range(0, 40_000, 5_000):
            writer.add(k, ids[k : k + 5_000])
        writer.close()
    from tidemark.llm.files import opened

    with opened(f"file:{tmp_path}/x") as source:
        reader = packed.Reader(source)
        assert reader.ids(8190, 16390).tolist() == list(range(8190, 16390))
        assert [d for d, _, _ in reader.documents(run=1)] == list(range(0, 40_000, 5_000))


def test_token_counts_across_blocks(docs):
    got = sorted(map(tuple, token_counts.token_counts(docs).collect()), key=str)
    assert got == sorted(((r[0], len(tokens(r[1], 0)) - 1) for r in ROWS), key=str)
    placed = token_counts.write_flat(docs)
    files = token_counts.file_sizes(placed.select("part", "path").distinct())
    small = token_counts.scan_flat(files, block_bytes=64)
    assert rows(small, "part", "place", "n_tokens") == rows(token_counts.scan_flat(files), "part", "place", "n_tokens")


# ---- substrings


def brute_substrings(data):
    least = {}
    for doc, text in data:
        w = words(text)
        for i in range(len(w) - 12) if doc is not None else ():
            least[tuple(w[i : i + 13])] = min(least.get(tuple(w[i : i + 13]), doc), doc)
    out = []
    for doc, text in data:
        w, gone = words(text), set()
        for i in range(len(w) - 12) if doc is not None else ():
            if least[tuple(w[i : i + 13])] < doc:
                gone |= set(range(i, i + 13))
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def shared_passages(rng, alphabet, n_docs=40):
    passages = [[rng.choice(alphabet) for _ in range(rng.randrange(10, 40))] for _ in range(6)]
    data = []
    for doc in range(n_docs):
        parts = []
        for _ in range(rng.randrange(5)):
            parts += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(alphabet) for _ in range(rng.randrange(30))]
        data.append((doc, " ".join(parts)))
    return data


@pytest.mark.parametrize("size", [1, 2, 5, 300])
@pytest.mark.parametrize("hot", [substrings.HOT, 1])
def test_substrings_equal_brute_force(spark, size, hot):
    data = shared_passages(random.Random(size), [f"w{i}" for i in range(size)])
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = substrings.deduplicated(df, hot=hot)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == brute_substrings(data)


def test_substrings_on_hard_rows(docs):
    got = substrings.deduplicated(docs)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == brute_substrings([(r[0], r[1]) for r in ROWS])


def test_window_keys_depend_on_the_window_only():
    rng = np.random.default_rng(3)
    for size in (2, 3, 50):
        inner = rng.integers(0, size, 30).astype(np.uint64)
        keys = set()
        for _ in range(30):
            left, right = (rng.integers(0, size, rng.integers(0, 20)).astype(np.uint64) for _ in range(2))
            found = recompress.window_keys(np.concatenate([left, inner, right]), 13)
            keys.add(tuple(found[len(left) : len(left) + 18].tolist()))
        assert len(keys) == 1


# ---- suffixes


def brute_suffixes(data):
    seen, twice = set(), set()
    for doc, b in data:
        for i in range(len(b) - 199):
            (twice if b[i : i + 200] in seen else seen).add(b[i : i + 200])
    out = []
    for doc, b in data:
        drop = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if b[i : i + 200] in twice:
                drop[i : i + 200] = True
        runs = int((np.diff(np.concatenate([[0], drop.astype(int)])) == 1).sum())
        kept = bytes(x for x, d in zip(b, drop, strict=False) if not d)
        out.append((doc, len(b), int(drop.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def suffix_rows(df, **limits):
    return rows(suffixes.deduplicated(df, **limits).withColumn("sha", F.sha2("kept", 256)), "doc_id", "n_bytes", "n_removed", "n_spans", "sha")


@pytest.mark.parametrize("bucket_rows", [suffixes.BUCKET_ROWS, 3, 1])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefghé "])
def test_suffixes_equal_brute_force(spark, alphabet, bucket_rows):
    rng = random.Random(len(alphabet))
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(150, 700))) for _ in range(6)]
    passages.append("ab" * 300)
    data = []
    for doc in range(40):
        parts = []
        for _ in range(rng.randrange(5)):
            cut = rng.choice(passages)
            a = rng.randrange(len(cut) // 2)
            parts.append(cut[a : a + rng.randrange(len(cut))])
            parts.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(200))))
        data.append((doc, "".join(parts)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert suffix_rows(df, bucket_rows=bucket_rows) == brute_suffixes([(d, t.encode()) for d, t in data])


def test_suffixes_on_hard_rows(docs):
    data = [(r[0], (r[1] or "").encode()) for r in ROWS if len(r[1] or "") < 9000]
    df = docs.where("coalesce(length(text), 0) < 9000")
    assert suffix_rows(df) == brute_suffixes(data)
    assert suffixes.deduplicated(docs).count() == len(ROWS)


def test_bucket_equals_brute_force():
    rng = random.Random(5)
    key = bytes(rng.randrange(97, 99) for _ in range(64))
    for _ in range(20):
        tails = [bytes(rng.randrange(97, 99) for _ in range(140)) for _ in range(3)]
        heads = [bytes(rng.randrange(97, 99) for _ in range(140)) for _ in range(3)]
        strings, leads = [], []
        for h in heads:
            for t in tails:
                lead = rng.randrange(100, 137)
                strings.append(h[140 - lead :] + key + t[: rng.randrange(100, 136)])
                leads.append(lead)
        pairs = {(s, lead) for s, lead in zip(strings, leads, strict=True) if len(s) >= 200}
        strings, leads = [p[0] for p in pairs], [p[1] for p in pairs]
        count = {}
        for s, lead in pairs:
            for i in range(len(s) - 199):
                count[lead - i, s[i : i + 200]] = count.get((lead - i, s[i : i + 200]), 0) + 1
        for (s, lead), got in zip(pairs, suffixes.repeated_in_bucket(strings, leads), strict=True):
            hits = [i for i in range(len(s) - 199) if count[lead - i, s[i : i + 200]] > 1]
            assert got == ((min(hits), max(hits)) if hits else None)


# ---- mixing


def brute_targets(sizes, weights):
    total, caps = 1.5 * sum(sizes.values()), {s: 2 * n for s, n in sizes.items()}
    target, full = {}, set()
    while True:
        left = total - sum(caps[s] for s in full)
        share = {s: left * weights[s] / sum(w for x, w in weights.items() if x not in full) for s in sizes if s not in full}
        above = {s for s, t in share.items() if t >= caps[s]}
        if not above:
            return {**{s: caps[s] for s in full}, **share}
        full |= above
        if len(full) == len(sizes):
            return caps


def test_mix_reaches_its_targets(spark):
    rng = random.Random(7)
    data = [(i, "w " * rng.randrange(1, 40), rng.choice(["é", "a", "Z", None, "b", "c", "d"])) for i in range(4000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.rated(mixing.sized(df).withColumn("digest", mixing.text_digest())).collect()
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = brute_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
    assert all(taken[s] == pytest.approx(want[s], rel=0.1) for s in sizes)
    mixed = mixing.mix(df).groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " ")))).collect()
    assert {r[0]: r[1] for r in mixed} == {s: n for s, n in taken.items() if n}


def test_mix_draws_texts_without_or_with_one_id_each_for_itself(spark):
    for doc in (None, 7):
        data = [(doc, f"w{i} " * 10, "big") for i in range(1000)] + [(-i, "v " * 10, "small") for i in range(600)]
        df = spark.createDataFrame(data, "doc_id long, text string, source string")
        big = mixing.rated(mixing.sized(df).withColumn("digest", mixing.text_digest())).where("source = 'big'")
        got = big.agg(F.sum(F.col("size") * F.col("copies")), F.first("target"), F.first("source_size")).first()
        assert got[1] % got[2] and got[0] == pytest.approx(got[1], rel=0.1)


# ---- all


def test_quality_stage_keeps_columns_named_like_measures(docs):
    clash = docs.withColumn("n_words", F.lit("own")).withColumn("fail_bits", F.lit("own")).withColumn("n_lines", F.lit("own"))
    kept = quality.kept(clash)
    assert kept.columns == clash.columns
    assert {tuple(r) for r in kept.select("n_words", "fail_bits", "n_lines").collect()} == {("own",) * 3}
    plain = quality.ledger(docs).where(quality.passes(quality.POLICIES["v1"]))
    assert rows(kept, "doc_id", "text") == rows(plain, "doc_id", "text")


def test_clashing_columns_do_not_matter(docs, clashing):
    for run, names in (
        (quality.ledger, ("doc_id", "n_words", "fail_bits")),
        (simhash.near_duplicates, ("doc_id", "component_id")),
        (substrings.deduplicated, ("doc_id", "n_removed")),
        (token_counts.token_counts, ("doc_id", "n_tokens")),
    ):
        assert rows(run(clashing), *names) == rows(run(docs), *names)
    for stage in (simhash.deduplicated, mixing.mix):
        assert stage(clashing).columns == clashing.columns and stage(clashing).count() == stage(docs).count()
    assert suffixes.deduplicated(clashing.where("doc_id < 7")).count() == 7
    assert pseudonyms.with_pseudonyms(clashing).count() == len(ROWS)


def test_queries_on_empty_tables(spark, empty, sf_dir):
    path = sf_dir(
        documents=empty,
        benchmark=spark.createDataFrame([], "item_id long, text string"),
        pages=spark.createDataFrame([], "page_id long, url string, html string"),
        conversations=spark.createDataFrame([], "conv_id long, turn long, role string, text string"),
    )
    for name, query in registry.queries().items():
        assert query(spark, path).count() == 0, name
    assert corpus_pipeline.run(spark, path).count() == 0


def test_pipeline_on_hard_rows(spark, docs, sf_dir):
    good = " ".join(f"clean{i}" for i in range(80))
    leak = " ".join(f"item{i}" for i in range(30))
    more = spark.createDataFrame(
        [(20, good + " first", "en", "a", 1), (21, good + " " + leak, "en", "a", 1), (22, "Ä" + good[::-1], "en", None, 1)],
        docs.schema,
    )
    path = sf_dir(documents=docs.unionByName(more), benchmark=spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string"))
    stage = spark.read.parquet(f"{path}/documents.parquet")
    seen = []
    for name, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, stage, path)
        assert stage.columns == docs.columns, name
        seen.append({r["doc_id"] for r in stage.collect()})
    assert 3 not in seen[0] and 7 not in seen[0] and {1, 2, 20, 21, 22} <= seen[0]
    assert 2 not in seen[1] and {1, 20, 21, 22} <= seen[1]
    assert 21 not in seen[2] and {1, 20, 22} <= seen[2]
    assert seen[3] <= seen[2]
    assert corpus_pipeline.run(spark, path).count() == stage.count()
