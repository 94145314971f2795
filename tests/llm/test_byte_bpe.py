"""BPE through the lexicon against the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, transducer

from llm.conftest import ROWS

PATH = byte_bpe.public_byte_vocabulary()
ALPHABET = [
    "a", "b", "the", " ", "  ", "\n", "\t", "'s", "'ll", "é", "中", "文", "123", "٣", "!", "?", "\x1c", "\x85", " ",
    "<|endoftext|>", "<|", "՘", "🙂", "\U00010940", "\x00", "ing", "ŉ", "²", "‍", "　", "ﬁ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(text, size=50):
    bpe, out = byte_bpe.byte_bpe(PATH), []
    for pieces, special in bpe.parts(text, size):
        for piece in pieces:
            out += bpe.merge(piece.encode())
        out += [] if special is None else [special]
    return out


def test_ids_and_decoding_equal_the_library(library):
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(text) == ids
        assert byte_bpe.byte_bpe(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_ids_that_are_no_text_decode_alike(library):
    rng, bpe = random.Random(2), byte_bpe.byte_bpe(PATH)
    for _ in range(300):
        ids = [rng.randrange(bpe.size) for _ in range(20)]
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["ab" * 50_000, "a" * 5000, "xyzzy " * 3, "x" * 63, "x" * 64, " " * 3000 + "a"])
def test_long_pieces_merge_alike(library, text):
    assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_all_settled_characters_split_alike():
    bpe = byte_bpe.byte_bpe(PATH)
    settled = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and byte_bpe._SETTLED.fullmatch(chr(c))]
    plain = [c for c in settled if byte_bpe._PLAIN.fullmatch(c)]
    assert len(plain) > 500
    for form in ("a{}b ", "1{}2 ", "!{}? ", " {} ", "  {}a\n"):
        for chars, split in ((settled, bpe.rule.findall), (plain, byte_bpe._PLAIN_SPLIT.findall)):
            text = "".join(form.format(c) for c in chars)
            assert split(text) == [text[a:b] for _, (a, b) in bpe.own.pre_tokenize_str(text)]


def test_transducer_lists_exactly_its_words():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdé ") for _ in range(rng.randrange(9))).encode() for _ in range(3000)})
    listed = {w: tuple(rng.randrange(9) for _ in range(rng.randrange(4))) for w in words[::2]}
    lexicon = transducer.Lexicon(transducer.compiled(sorted(listed.items())))
    sizes = np.array([len(w) for w in words])
    known, counts, ids = lexicon.find(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert known.tolist() == [w in listed for w in words]
    assert counts.tolist() == [len(listed.get(w, ())) for w in words]
    assert ids.tolist() == [i for w in words for i in listed.get(w, ())]


def test_transducer_shares_suffixes():
    ends = [b"ing", b"ed", b"s"]
    words = sorted(a + b for a in (b"walk", b"talk", b"jump") for b in ends)
    arcs = len(transducer.Lexicon(transducer.compiled((w, (1,)) for w in words)).keys)
    assert arcs < sum(map(len, words)) / 2


def test_words_come_sorted():
    with pytest.raises(ValueError):
        transducer.compiled([(b"b", (1,)), (b"a", (2,))])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


HARD = [*ROWS, (10, "a <|endoftext|><|endoftext|> b", "en", "a", 1), (11, "<|endoftext|>", "en", "a", 1), (12, "Əli ՘ 中文", None, None, 0)]


@pytest.mark.parametrize("words", [1, 40, byte_bpe.WORDS])
def test_every_lexicon_gives_the_librarys_ids(spark, docs, library, words):
    df = spark.createDataFrame(HARD, docs.schema)
    done = byte_bpe.decode(byte_bpe.encode(df, byte_bpe.compile_lexicon(df, words=words)))
    got = [(r["doc_id"], len(r["ids"]), sha(",".join(map(str, r["ids"]))), sha(r["decoded"])) for r in done.collect()]
    assert sorted(got, key=str) == sorted(((r[0], *expected(library, r[1])) for r in HARD), key=str)


def test_query_on_hard_rows(spark, docs, library, sf_dir):
    df = spark.createDataFrame(HARD, docs.schema).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    got = byte_bpe.op11_bpe_round_trip(spark, sf_dir(documents=df))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((r[0], *expected(library, r[1])) for r in HARD), key=str)


def test_empty_table(empty, spark, sf_dir):
    assert byte_bpe.op11_bpe_round_trip(spark, sf_dir(documents=empty)).collect() == []


def test_frequent_words_are_the_most_frequent(spark):
    counts = spark.createDataFrame([(b"w%d" % k, 1 + 1000 // (k + 1)) for k in range(500)], "word binary, n long")
    for words in (0, 1, 7, 100, 500, 10_000):
        got = [r["n"] for r in byte_bpe.frequent(counts, words).collect()]
        rest = [1 + 1000 // (k + 1) for k in range(500)]
        for n in got:
            rest.remove(n)
        assert len(got) <= words and (not got or not rest or min(got) > max(rest))
        assert len(got) >= min(words, 500) * 0.6


def test_word_counts_cover_all_rows(docs, library):
    got = {bytes(r["word"]).decode(): r["n"] for r in byte_bpe.word_counts(docs, PATH).collect()}
    want = {}
    for row in ROWS:
        for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(row[1] or ""):
            want[row[1][a:b]] = want.get(row[1][a:b], 0) + 1
    assert got == want


def test_a_task_counts_a_repeated_piece_once():
    texts = [" ".join(f"w{k % 500}" for k in range(100_000)), None, ""] * 5
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 4], pa.string())], ["text"]) for k in range(0, len(texts), 4)]
    got = pa.Table.from_batches(byte_bpe.counted(iter(batches), PATH)).to_pydict()
    assert len(got["word"]) == len(set(got["word"]))
    pieces = {}
    for text in texts:
        for part, _ in byte_bpe.byte_bpe(PATH).parts(text or ""):
            for piece in part:
                pieces[piece.encode()] = pieces.get(piece.encode(), 0) + 1
    assert dict(zip(got["word"], got["n"], strict=True)) == pieces


def test_counting_holds_bounded_pieces_and_characters(monkeypatch):
    monkeypatch.setattr(byte_bpe, "HELD", 100)
    monkeypatch.setattr(byte_bpe, "READ", 5_000)
    short, long = [f"a{k} b{k} c{k}" for k in range(200)], ["x" * 3_000 + str(k) for k in range(10)]
    batch = pa.RecordBatch.from_arrays([pa.array(short + long, pa.string())], ["text"])
    got = [b.to_pydict() for b in byte_bpe.counted(iter([batch]), PATH)]
    assert max(len(b["word"]) for b in got) <= 110
    assert max(sum(map(len, b["word"])) for b in got) <= 8_500
    assert sum(n for b in got for n in b["n"]) == sum(len(p) for t in short + long for p, _ in byte_bpe.byte_bpe(PATH).parts(t))


def test_lexicon_writes_no_table_of_counts(spark, docs, monkeypatch, tmp_path):
    monkeypatch.setattr(byte_bpe, "fresh_folder", lambda _, purpose: f"file:{tmp_path}/{purpose}")
    monkeypatch.setattr("tidemark.llm.common.fresh_folder", lambda _, purpose: f"file:{tmp_path}/{purpose}")
    path = byte_bpe.compile_lexicon(docs)
    assert len(transducer.Lexicon.open(path).keys) > 400
    assert [p.name for p in tmp_path.iterdir()] == ["llm-lexicon"]
