"""Byte-level BPE: texts to ids and back, by the tokenizers library over Arrow batches.

A byte-level vocabulary writes each byte as one printable character; `byte_characters` is that
table. Encoding gives ids with offsets into the text's characters and bytes; decoding reverses the table, so that
a character split over several tokens comes back whole.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Callable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import batch_of, id_and_text, slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already

# Fixed value: how text is cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS_KEPT = 300_000  # distinct words a worker remembers, and as many older ones
LONG_WORD = 64
# Perhaps a line break, letters that every version of Unicode calls so, perhaps marks: a match of the pattern each.
PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def load_json(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def shown_tokens(path: str) -> dict[bytes, str]:
    """The tokens of a file of ranks as a byte-level vocabulary writes them."""
    table = byte_characters()
    return {token: "".join(table[b] for b in token) for token in read_ranks(path)}


def load_ranks(path: str):
    """A tokenizer that merges as tiktoken does with the ranks in `path`.

    Any two neighbours whose joined bytes have a rank may merge, least rank first; so every split
    of a token into two others is a merge, in the order of ranks. A word that is a token is not
    merged at all. There are no special tokens.
    """
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    ranks, shown = read_ranks(path), shown_tokens(path)
    merges = []
    for token in sorted(ranks, key=ranks.get):
        splits = [(token[:k], token[k:]) for k in range(1, len(token))]
        splits = [(a, b) for a, b in splits if a in ranks and b in ranks]
        splits.sort(key=lambda pair: (ranks[pair[0]], ranks[pair[1]]))
        merges += [(shown[a], shown[b]) for a, b in splits]
    model = models.BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(PATTERN), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    tokenizer.decoder = decoders.ByteLevel()
    return tokenizer


def _merger(tokenizer):
    """A tokenizer's model without its pattern, for runs of bytes as the vocabulary writes them, with | between."""
    from tokenizers import Tokenizer, pre_tokenizers

    merger = Tokenizer(tokenizer.model)
    merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("|")
    return merger


def _spaced(word: str) -> str:
    """A remembered word as it stands in a text."""
    return word if word[0] == "\n" else " " + word


class PieceEncoder:
    """Encodes texts word by word, remembering words.

    A single space between two characters that are no white space always starts a new match of
    the pattern, and a single line break there is a match of its own, so a text may be cut before
    both without changing any id. Each distinct word goes through the tokenizer once while it is
    remembered; many new words go in one call, joined as they would stand in a text, and their ids
    are parted again by the bytes of the tokens. Of a `PLAIN` word the matches are known: only its
    letters are merged, by the tokenizer's own model without the pattern, and once for all words
    that differ in the marks after them. Ids are kept packed, as little-endian 32-bit numbers.
    """

    _shared: dict = {}

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.lengths = np.array([len(token) for token in token_bytes(tokenizer)], np.int64)
        # Keys are words after a space, without it, or with the line break they follow; what starts a text is kept
        # apart, marks that end plain words too.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.other_space = re.compile(r"[^\S \n]")
        self.cut = re.compile(r"(?<=\S)(?: (?=\S)|(?=\n\S))").split
        self.merger = _merger(tokenizer)
        self.table = byte_characters()
        self.line_break = self._ids(["\n"])[0]

    @classmethod
    def shared(cls, path: str, load: Callable) -> PieceEncoder:
        """One per worker process and vocabulary."""
        key = (path, load.__name__)
        if key not in cls._shared:
            cls._shared[key] = cls(load(path))
        return cls._shared[key]

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(got.ids, "<u4").tobytes() for got in encoded]

    def _parted(self, packed: bytes, sizes: list[int]) -> Iterator[bytes]:
        """`packed` cut into the ids of stretches of so many bytes of text."""
        ends = np.cumsum(self.lengths[np.frombuffer(packed, "<u4")])
        places = 4 * (np.searchsorted(ends, np.cumsum(sizes)) + 1)
        start = 0
        for end in places.tolist():
            yield packed[start:end]
            start = end

    def _merge(self, runs: list[str]) -> dict[str, bytes]:
        """The ids of distinct runs of bytes, written as the vocabulary does and each one match of the pattern."""
        found: dict[str, bytes] = {}
        for low in range(0, len(runs), 20_000):
            part = runs[low : low + 20_000]
            groups = ["|".join(part[at : at + 200]) for at in range(0, len(part), 200)]
            encoded = self.merger.encode_batch_fast(groups, add_special_tokens=False)
            packed = b"".join([np.array(got.ids, "<u4").tobytes() for got in encoded])
            found.update(zip(part, self._parted(packed, [len(run) for run in part]), strict=True))
        return found

    def _learn_plain(self, words: list[str]) -> list[str]:
        """Learns the plain ones of `words` and returns the others."""
        # Lists of strings alone: tuples by the hundred thousand would keep the garbage collector busy.
        match, table = PLAIN.fullmatch, self.table
        others: list[str] = []
        plain: list[str] = []
        runs: list[str] = []
        after: list[str] = []
        for word in words:
            found = match(word)
            if found is None:
                others.append(word)
                continue
            before, run, marks = found.groups()
            if not run.isascii():
                run = "".join([table[b] for b in run.encode()])
            plain.append(word)
            runs.append(run if before else table[32] + run)
            after.append(marks)
        merged = self._merge(list(set(runs)))
        if len(self.marks) > WORDS_KEPT:
            self.marks.clear()
        new = list(set(after).difference(self.marks))
        self.marks.update(zip(new, self._ids(new), strict=True))
        packed = map(add, map(merged.__getitem__, runs), map(self.marks.__getitem__, after))
        self.words.update(zip(plain, packed, strict=True))
        for word in plain:
            if word[0] == "\n":
                self.words[word] = self.line_break + self.words[word]
        return others

    def _learn(self, words: list[str]) -> None:
        others = self._learn_plain(words)
        # What ends in white space would take in the next word's space.
        alone = [word for word in others if word[-1].isspace()]
        for word, packed in zip(alone, self._ids([_spaced(word) for word in alone]), strict=True):
            self.words[word] = packed
        joined = [word for word in others if not word[-1].isspace()]
        for low, high in slices(joined, 100_000):
            part = joined[low:high]
            texts = [_spaced(word) for word in part]
            packed = self._ids(["".join(texts)])[0]
            sizes = [len(text.encode("utf-8", "surrogatepass")) for text in texts]
            self.words.update(zip(part, self._parted(packed, sizes), strict=True))

    def _single_gaps(self, text: str) -> bool:
        """Whether all white space is single spaces and line breaks between other characters."""
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text:
            return False
        return not (text[:1].isspace() or text[-1:].isspace() or self.other_space.search(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if len(self.words) > WORDS_KEPT:  # words in use come back from the older ones
            self.older, self.words = self.words, {}
        if len(self.starts) > WORDS_KEPT:
            self.starts.clear()
        # Arrow cuts the texts and numbers the distinct words, so that each is looked up once for all its places.
        heads: list[str] = []
        tails: list[str | None] = []
        odd: dict[int, list[str]] = {}
        for place, text in enumerate(texts):
            if self._single_gaps(text):
                head, gap, tail = text.replace("\n", " \n").partition(" ")
                tails.append(tail if gap else None)
            else:
                odd[place] = self.cut(text)
                head = odd[place].pop(0)
                tails.append(None)
            heads.append(head)
        cut = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = list(set(heads).difference(self.starts))
        self.starts.update(zip(first, self._ids(first), strict=True))
        new = set(distinct).union(*odd.values())
        new = new.difference(self.words)  # looks each up; an update would go through all known words
        for word in new & self.older.keys():
            self.words[word] = self.older[word]
            new.discard(word)
        if new:
            self._learn(list(new))
        look_up = self.words.__getitem__
        packed = pa.array(list(map(look_up, distinct)), pa.large_binary()).take(numbered.indices)
        out = [self.starts[head] for head in heads]
        if len(packed):
            _, ends, data = packed.buffers()
            bounds = np.frombuffer(ends, "<i8")[cut.offsets.to_numpy()].tolist()
            view = memoryview(data)
            out = [start + view[low:high] for start, low, high in zip(out, bounds[:-1], bounds[1:], strict=True)]
        for place, words in odd.items():
            out[place] += b"".join(map(look_up, words))
        for word in first:
            if len(word) > LONG_WORD:
                del self.starts[word]
        for word in new:
            if len(word) > LONG_WORD:
                del self.words[word]
        return out


def _byte_places(text: str) -> np.ndarray:
    """The byte offset of each character, and the length in bytes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate(([0], np.cumsum(width)))


def reversed_bytes(vocabulary: dict[str, int], special: dict[int, bytes] | None = None) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary, by the byte table read backwards; ids that are missing
    have none. A special token is its own text."""
    reverse = {shown: byte for byte, shown in enumerate(byte_characters())}
    special = special or {}
    table = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        table[i] = special[i] if i in special else bytes(reverse[c] for c in token)
    return table


def token_bytes(tokenizer) -> list[bytes]:
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    return reversed_bytes(tokenizer.get_vocab(), special)


_tables: dict = {}


def read_table(path: str, load: Callable) -> list[bytes]:
    """The bytes of each id of a vocabulary file, read once per worker process.

    For a file of ranks the vocabulary is made without the merges, which decoding does not need.
    """
    key = (path, load.__name__)
    if key not in _tables:
        if load is load_ranks:
            ranks = read_ranks(path)
            _tables[key] = reversed_bytes({shown: ranks[token] for token, shown in shown_tokens(path).items()})
        else:
            _tables[key] = token_bytes(load(path))
    return _tables[key]


def _token_places(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths)
    starts = ends - lengths
    if text.isascii():
        return starts, ends, starts, ends
    places = _byte_places(text)
    return starts, ends, np.searchsorted(places, starts, "right") - 1, np.searchsorted(places, ends, "left")


def offsets_checksum(text: str, lengths: np.ndarray, block: int = 1_000_000) -> int:
    """CRC-32 of the first and end character of each token, as little-endian unsigned 32-bit numbers in turn."""
    _, _, first, last = _token_places(text, lengths)
    found = 0
    for low in range(0, len(first), block):
        part = slice(low, low + block)
        found = zlib.crc32(np.stack([first[part], last[part]], axis=1).astype("<u4").tobytes(), found)
    return found


def offsets_of(text: str, ids: list[int], table: list[bytes]) -> list[tuple[int, int, int, int]]:
    """Per token: first byte, end byte, first character and end character it touches.

    Tokens of one split character all point to that character.
    """
    places = _token_places(text, np.array([len(table[i]) for i in ids], np.int64))
    return list(zip(*(x.tolist() for x in places), strict=True))


def encode(
    df: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    load: Callable = load_ranks,
    offsets: bool = False,
    checksums: bool = False,
) -> DataFrame:
    """`id, ids_packed` for every row: ids as little-endian 32-bit numbers, in one binary value.

    With `offsets`, also `offsets`: an array of byte and character ranges, one per token. With `checksums`, also
    `offsets_crc32`: the checksum of the character ranges, see `offsets_checksum`. Null
    and empty texts have no tokens; ids of rows may be null or repeat; an empty table gives no rows. A text is held
    in its task whole, with its ids (and, for offsets, its characters' places) beside it: some 4 bytes per token, and
    about 40 per character that the offsets of a text beyond ASCII need.
    """
    fields = [("id", pa.int64()), ("ids_packed", pa.binary())]
    names = ("byte_start", "byte_end", "char_start", "char_end")
    ddl = "id long, ids_packed binary"
    if offsets:
        fields.append(("offsets", pa.list_(pa.struct([(n, pa.int64()) for n in names]))))
        ddl += ", offsets array<struct<byte_start:long,byte_end:long,char_start:long,char_end:long>>"
    if checksums:
        fields.append(("offsets_crc32", pa.int64()))
        ddl += ", offsets_crc32 long"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.shared(vocabulary, load)
        table = token_bytes(encoder.tokenizer) if offsets else []
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for low, high in slices(texts):
                packed = encoder.encode(texts[low:high])
                out = [ids.slice(low, high - low), packed]
                if offsets:
                    rows = zip(texts[low:high], packed, strict=True)
                    found = [offsets_of(t, np.frombuffer(p, "<u4").tolist(), table) for t, p in rows]
                    out.append([[dict(zip(names, x, strict=True)) for x in row] for row in found])
                if checksums:
                    rows = zip(texts[low:high], packed, strict=True)
                    out.append([offsets_checksum(t, encoder.lengths[np.frombuffer(p, "<u4")]) for t, p in rows])
                yield batch_of(schema, *out)

    return id_and_text(df, id_col, text_col).mapInArrow(run, ddl)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids_packed", *, load: Callable = load_ranks) -> DataFrame:
    """`df` with `decoded` (binary): the bytes of the packed ids in `ids_col`, exactly.

    Cut at any token the bytes may end inside a character; they are joined before anyone reads
    them as text. Tokens are read from the vocabulary as it writes them, by the byte table backwards. Null ids give
    null; an unknown id raises.
    """
    place = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read_table(vocabulary, load)
        for batch in batches:
            decoded = [
                None if packed is None else b"".join([table[i] for i in np.frombuffer(packed, "<u4").tolist()])
                for packed in batch.column(place).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"]
            )

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("decoded", BinaryType())]))

