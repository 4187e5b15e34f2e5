import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pactframe.llm import byte_bpe as b

from .conftest import ODD_ROWS, SMALL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    source = random.Random(8)
    pools = ["ab ", "a'st rev", " \n\t", "=-_ ", "é漢🙂 a", "0123 x", "aA'LL 's", "   b\x1c\x85", "<|endoftext|> "]
    texts = ["".join(source.choice(pool) for _ in range(source.randrange(1, 60))) for pool in pools for _ in range(60)]
    everything = "".join(pools)
    texts += ["".join(source.choice(everything) for _ in range(80)) for _ in range(300)]
    return texts + ["=" * 700, "a" * 500, " " * 90, "x \n y", " lead", "trail ", "a  b", "it's  we'll", "<|endoftext|>"]


def test_ids_equal_tiktoken(tik):
    encoder = b.PieceEncoder(b.load_ranks(RANKS))
    texts = odd_texts()
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == tik.encode_ordinary(text), repr(text)


def test_word_by_word_equals_whole_texts():
    tokenizer = b.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    texts = odd_texts()
    for text, packed in zip(texts, b.PieceEncoder(tokenizer).encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_round_trip_and_offsets(docs, tik):
    rows = b.decode(b.encode(docs(ODD_ROWS), RANKS, offsets=True), RANKS).collect()
    texts = [text or "" for _, text in ODD_ROWS]
    assert sorted(bytes(r["decoded"]) for r in rows) == sorted(t.encode() for t in texts)
    for row in rows:
        data = bytes(row["decoded"])
        text, ids = data.decode(), np.frombuffer(row["ids_packed"], "<u4").tolist()
        assert ids == tik.encode_ordinary(text)
        at = 0
        for i, o in zip(ids, row["offsets"], strict=True):
            assert o["byte_start"] == at and data[at : o["byte_end"]] == tik.decode_single_token_bytes(i)
            at = o["byte_end"]
            around = text[o["char_start"] : o["char_end"]].encode()
            assert data[o["byte_start"] : o["byte_end"]] in around
        assert at == len(data)


def test_split_character_comes_back(docs):
    rows = b.encode(docs([(1, "🙂漢")]), RANKS).collect()
    ids = np.frombuffer(rows[0]["ids_packed"], "<u4")
    table = b.token_bytes(b.load_ranks(RANKS))
    parts = [table[i] for i in ids.tolist()]
    assert len(parts) > 2 and b"".join(parts).decode() == "🙂漢"
    assert parts[0].decode("utf-8", "replace") == "�"


def test_null_ids_and_empty_table(session, docs):
    assert b.encode(docs([]), RANKS).collect() == []
    frame = session.createDataFrame([(None,)], "ids_packed binary")
    assert b.decode(frame, RANKS).collect()[0]["decoded"] is None


def test_forgotten_words_change_nothing(monkeypatch):
    monkeypatch.setattr(b, "WORDS_KEPT", 3)
    tokenizer = b.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = b.PieceEncoder(tokenizer)
    for _ in range(3):
        for text in ("one two three four", "five " * 9, "x" * 200):
            assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text).ids
    assert "x" * 200 not in encoder.words


class Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, inner):
        self.inner, self.characters = inner, 0

    def encode_batch_fast(self, texts, **options):
        self.characters += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **options)


def test_plain_words_are_merged_once_whatever_stands_around_them():
    tokenizer = b.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    words = ["thountan", "ciónbo", "erbleon", "öieung", "Haanth", "inntea", "nting", "élle"]
    marks = ["", ",", ".", "!?", "'", '")']
    lines = [f"{x}{m}\n{y}{n} {x}{n}" for x in words for y in words for m in marks for n in marks]
    text = " ".join(lines)
    encoder = b.PieceEncoder(tokenizer)
    encoder.tokenizer, encoder.merger = Counting(tokenizer), Counting(encoder.merger)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text).ids
    assert encoder.tokenizer.characters < 30  # the start and the marks
    assert encoder.merger.characters < 3 * sum(map(len, words))  # each after a space and after a line break
    assert len(encoder.words) <= 2 * len(words) * len(marks)


def test_letters_of_plain_words_are_one_match():
    import unicodedata

    letters = [chr(c) for c in range(0x250) if b.PLAIN.fullmatch(chr(c))]
    assert len(letters) == 52 + 62 + 0x150 and all(unicodedata.category(c)[0] == "L" for c in letters)
    tokenizer = b.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    pairs = list(zip(letters, letters[::-1], strict=True))
    texts = [f"x {c}{d}{m} {c}\n{d}{m}" for c, d in pairs for m in ("", "|", "''", "-_~")]
    for text, packed in zip(texts, b.PieceEncoder(tokenizer).encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == tokenizer.encode(text).ids, repr(text)


@pytest.mark.parametrize("gap", ["\n", " \n", "\n ", "\n\n", "\n\n\n ", "\r\n", "\n\t", "\x1c\n", "\n\x85"])
def test_line_breaks(gap):
    texts = [f"one two,{gap}three", f"{gap}one{gap}", f"a's{gap}'s b's {gap}it", f"é {gap}<|endoftext|>{gap}12 x."]
    for tokenizer in (b.load_ranks(RANKS), b.load_json(public_tokenizers.path("byte_bpe_50k.json"))):
        for text, packed in zip(texts, b.PieceEncoder(tokenizer).encode(texts), strict=True):
            assert np.frombuffer(packed, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def plain_checksum(text, ids, tik):
    """The checksum of character ranges by plain Python: the character of each byte, looked up."""
    character, at, out = [k for k, c in enumerate(text) for _ in c.encode()], 0, b""
    for i in ids:
        end = at + len(tik.decode_single_token_bytes(i))
        out += character[at].to_bytes(4, "little") + (character[end - 1] + 1).to_bytes(4, "little")
        at = end
    assert at == len(character)
    return zlib.crc32(out)


def test_checksums_of_offsets(docs, tik):
    texts = odd_texts()
    rows = b.encode(docs(list(enumerate(texts))), RANKS, checksums=True).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["id"]]
        assert row["offsets_crc32"] == plain_checksum(text, tik.encode_ordinary(text), tik), repr(text)
    lengths = np.ones(11, np.int64)
    assert b.offsets_checksum("a" * 11, lengths, block=2) == b.offsets_checksum("a" * 11, lengths)
    both = b.encode(docs([(1, "é🙂 a"), (2, None)]), RANKS, offsets=True, checksums=True).collect()
    assert [len(r["offsets"]) for r in sorted(both)][1] == 0 and sorted(both)[1]["offsets_crc32"] == 0


def test_decoding_reverses_the_byte_table(docs, monkeypatch):
    """Decoding goes by the vocabulary as it is written: with two of its characters exchanged, so are the bytes."""
    rows = b.encode(docs([(1, "abba cab")]), RANKS)
    characters = b.byte_characters()
    vocabulary = {shown: k for k, shown in enumerate(characters)}
    assert b.reversed_bytes(vocabulary) == [bytes([k]) for k in range(256)]
    assert b.reversed_bytes({"ab": 2, "<end>": 0}, {0: b"<end>"}) == [b"<end>", b"", b"ab"]
    x, y = ord("a"), ord("b")
    swapped = b.read_table(RANKS, b.load_ranks)
    characters[x], characters[y] = characters[y], characters[x]
    monkeypatch.setattr(b, "byte_characters", lambda: characters)
    vocabulary = {"".join(b.byte_characters()[k] for k in token): i for i, token in enumerate(swapped)}
    assert b.reversed_bytes(vocabulary) == swapped
    monkeypatch.undo()
    turned = bytes.maketrans(b"ab", b"ba")
    assert b.reversed_bytes(vocabulary) == [token.translate(turned) for token in swapped]
    assert bytes(b.decode(rows, RANKS).collect()[0]["decoded"]) == b"abba cab"


def test_query_on_the_table(session, tik):
    from pactframe.llm.queries import op2_byte_bpe

    texts = {r["doc_id"]: r["text"] for r in session.read.parquet(f"{SMALL}/documents.parquet").collect()}
    import hashlib

    for row in op2_byte_bpe(session, SMALL).collect():
        ids = tik.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
        assert row["offsets_crc32"] == plain_checksum(texts[row["doc_id"]], ids, tik)


def test_tables_with_and_without_a_tokenizer_agree():
    assert b.read_table(RANKS, b.load_ranks) == b.token_bytes(b.load_ranks(RANKS))
    table = b.read_table(public_tokenizers.path("byte_bpe_50k.json"), b.load_json)
    assert table[:50_256] == b.read_table(RANKS, b.load_ranks) and table[50_256] == b"<|endoftext|>"
