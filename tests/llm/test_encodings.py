"""Token ids of every character, whole-byte packing, and permutations of names of any length."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packed, pseudonyms, vocab


@pytest.mark.parametrize("plain_specials", [False, True])
def test_ids_of_every_character_equal_the_tokenizer(plain_specials):
    path = vocab.public_vocabulary()
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = plain_specials
    forms = ("{}", "a{}b", "a {} b", "1{}", "!{}?", "{}{}", "É{}é")
    texts = [f.replace("{}", chr(c)) for f in forms for c in range(0x3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = vocab.WordEncoder(path, plain_specials).each(texts)
    assert not [t for t, w, g in zip(texts, want, got, strict=True) if w != g.tolist()]


def test_ids_of_mixed_texts_equal_the_tokenizer(monkeypatch):
    monkeypatch.setattr(vocab, "REMEMBERED", 20)
    monkeypatch.setattr(vocab, "TOGETHER", 30)
    rng, library = random.Random(1), Tokenizer.from_file(vocab.public_vocabulary())
    parts = ["Əli Bakıda", "Ɓauna Ɗan", "<|endoftext|>", "<|", " ", "İ", "\xa0", "é", "é", "中", "123", "don't", "!!", "\n", "déƏo", "X"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(600)] + [None, ""]
    got = list(vocab.WordEncoder(vocab.public_vocabulary()).each(texts))
    assert [g.tolist() for g in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("bits", [1, 5, 8, 12, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 999, dtype=np.uint64).astype(np.uint32)
    data = packed.pack(ids, bits)
    assert len(data) == -(-999 * bits // 8)
    assert packed.unpack(data, bits, 999).tolist() == ids.tolist()


def bruteforce_bits(ids, bits):
    return sum(int(i) << k * bits for k, i in enumerate(ids)).to_bytes(-(-len(ids) * bits // 8), "little")


@pytest.mark.parametrize("bits", [7, 8, 16, 32])
def test_bits_lie_in_order(bits):
    ids = np.random.default_rng(1).integers(0, 1 << bits, 64, dtype=np.uint64).astype(np.uint32)
    assert packed.pack(ids, bits) == bruteforce_bits(ids, bits)


@pytest.mark.parametrize("length", range(1, 65))
def test_names_of_any_length_come_back(length):
    rng = random.Random(length)
    names = {"".join(rng.choice("abcXYZ0189") for _ in range(length)) for _ in range(8)}
    fresh = {pseudonyms.email(f"{n}@a.org", "key", False) for n in names}
    assert len(fresh) == len({n.lower() for n in names}) or length < 3
    for n in names:
        new = pseudonyms.email(f"{n}@a.org", "key", False)
        assert len(new) == length + 6
        assert [c.isdigit() for c in n] == [c.isdigit() for c in new[:length]]
        assert [c.isupper() for c in n] == [c.isupper() for c in new[:length]]
        assert pseudonyms.email(new, "key", True) == f"{n}@a.org"


def test_short_names_permute():
    """Brute force: all names of one shape, each once."""
    names = [f"{a}{d}" for a in "abcdefghijklmnopqrstuvwxyz" for d in range(10)]
    fresh = [pseudonyms.email(f"{n}@h.org", "key", False).partition("@")[0] for n in names]
    assert sorted(fresh) == sorted(names)


@pytest.mark.parametrize("length", [32, 63, 64, 65, 128, 129, 1000])
def test_secrets_of_any_length_and_case_come_back(length):
    rng = random.Random(length)
    for letters in ("0123456789abcdef", "0123456789ABCDEF", "0123456789abcdefABCDEF"):
        found = "".join(rng.choice(letters) for _ in range(length))
        new, spans = pseudonyms.pseudonymised(f"key={found};")
        assert [k for k, _, _ in spans] == ["secret"] and found not in new and len(new) == length + 5
        assert pseudonyms.restored(new, spans) == f"key={found};"
        assert pseudonyms.pseudonymised(new, back=True)[0] == f"key={found};"


def test_equal_values_stay_linked():
    def name(text):
        return pseudonyms.pseudonymised(text)[0]

    assert name("John.Doe@x.org").lower() == name("john.doe@x.org")
    key = "0123456789abcdef" * 8
    assert name(key).upper() == name(key.upper())


@pytest.mark.parametrize("size", [2, 3, 4, 5, 9, 10, 99, 100, 101])
def test_small_ranges_permute(size):
    assert sorted(pseudonyms.feistel(v, size, "k", "t") for v in range(size)) == list(range(size))


def test_huge_ranges_end():
    for size in (36**34, 36**42, 10**40 + 1, 2**400):
        value = pseudonyms.feistel(size - 1, size, "k", "t")
        assert 0 <= value < size and pseudonyms.feistel(value, size, "k", "t", True) == size - 1
