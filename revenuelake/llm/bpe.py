"""Byte-level BPE encoding and decoding.

A text is split by a fixed pattern and each piece ("word") encoded by itself. Words are encoded once however often
they occur: the distinct words are folded by Spark's higher-order functions, which merge, step by step, the
neighbours of least rank (the leftmost, if several) until no merge is left. A word that is a token itself is
that token. The table of ranks is a broadcast row of two flat arrays, in which a pair of tokens is found by one addition
(``RankTable``); words meet it many at a time, since every row of words is joined with the arrays. Of the words of texts, merges that are certain whatever
stands beside the pair (``certain_merges``), or whatever its neighbours grow to (``beside_merger``), are made before the fold, which does the
rest. Decoding joins the tokens' bytes.

The words of a text that many documents share are looked up in a dictionary of at most ``DICTIONARY_WORDS`` words,
the most frequent of the whole corpus that are no tokens; apart from the vocabulary nothing else is broadcast. All other words travel with
their texts, once for each slice of texts, and are folded by the same expression where they are. Texts are never shuffled.

Words longer than ``LONG_WORD`` bytes (few, and slow to fold in quadratic time) are merged with a heap by the same
rule.

Defined results: a null text is an empty one, with no tokens; ids may repeat or be null, and every row keeps its
own result; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from revenuelake.llm.common import hand_back, hand_back_driver, tidy, whole_text
from revenuelake.session import materialize, ship_package

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
DICTIONARY_WORDS = 3 << 17
LONG_WORD = 64
RANK_BITS = 20
BOUND_BITS = 20
SLICE_ROWS = 1000  # texts held at once by a Python worker
PIECE_BYTES = 1 << 19  # of texts split at once, unless one is longer
HELD_WORDS = 1 << 18  # words of slices that a Python worker holds before it counts them
LETTER, NUMBER, SPACE = 1, 2, 3
PILE_WORDS = 1 << 12  # words of the dictionary folded in one row


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file with one base64 token and rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}


@dataclass(frozen=True)
class RankTable:
    """Merges by displaced rows: the merge of (left, right) is at ``base[left] + right`` of ``slots``, if that slot
    names ``left`` as its owner. A slot holds ``left << RANK_BITS | merged``, an empty one 0."""

    base: np.ndarray
    slots: np.ndarray


def pair_merges(ranks: dict[bytes, int]) -> np.ndarray:
    """left, right, merged for every two tokens whose bytes together are a token."""
    numbers = (
        number
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
        for number in (ranks[token[:cut]], ranks[token[cut:]], rank)
    )
    return np.fromiter(numbers, dtype=np.int64).reshape(-1, 3)


def rank_table(ranks: dict[bytes, int]) -> RankTable:
    return table_of(pair_merges(ranks), max(ranks.values(), default=0) + 1)


def table_of(merges: np.ndarray, size: int) -> RankTable:
    """The table of some merges of ``size`` tokens."""
    merges = merges[np.lexsort((merges[:, 1], merges[:, 0]))]
    lefts, starts, counts = np.unique(merges[:, 0], return_index=True, return_counts=True)
    base = np.zeros(size, dtype=np.int64)
    slots = np.zeros(3 * max(len(merges), 1) + 2 * size, dtype=np.int64)
    tries = np.random.Generator(np.random.PCG64(7))
    for at in np.argsort(-counts, kind="stable"):
        rows = merges[starts[at] : starts[at] + counts[at]]
        while True:
            offset = int(tries.integers(0, len(slots) - size))
            if not slots[offset + rows[:, 1]].any():
                break
        base[lefts[at]] = offset
        # The owner is stored plus one, so that no used slot is 0.
        slots[offset + rows[:, 1]] = ((rows[:, 0] + 1) << RANK_BITS) | rows[:, 2]
    return RankTable(base, slots)


def certain_merges(merges: np.ndarray, size: int) -> np.ndarray:
    """The merges that happen wherever their two tokens meet, and may be made before all others.

    No other merge that takes one of the two tokens, and none that takes the merged one, has so low a rank: the former
    would come later, when the pair is gone, and the latter can't come before merges that the pair would have had to await.
    """
    left, right, merged = merges.T
    before, after = np.full((2, size), np.iinfo(np.int64).max)
    np.minimum.at(before, right, merged)  # the least rank with a neighbour before the token
    np.minimum.at(after, left, merged)
    sure = (left != right) & (merged < before[left]) & (merged < after[right]) & (merged < before[merged]) & (merged < after[merged])
    return merges[sure]


def merge_certain(tokens: np.ndarray, lengths: np.ndarray, certain: RankTable) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and lengths of words after their certain merges; no two of these ever share a token."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    while True:
        slot = certain.slots[certain.base[tokens[:-1]] + tokens[1:]]
        at = np.flatnonzero((slot >> RANK_BITS == tokens[:-1] + 1) & (word[:-1] == word[1:]))
        if not len(at):
            return tokens, np.bincount(word, minlength=len(lengths))
        tokens = tokens.copy()
        tokens[at] = slot[at] & ((1 << RANK_BITS) - 1)
        tokens, word = np.delete(tokens, at + 1), np.delete(word, at + 1)


@dataclass(frozen=True)
class Neighbours:
    """What may still happen beside a pair: least ranks of merges that take a token, given the token that now stands next to it.

    ``before`` has rows of next, token and the least rank of a merge of the token with any token that ends as ``next``
    does, to which that may have grown; ``after`` has token, next and the same for tokens that begin as ``next`` does.
    """

    merges: RankTable
    before: np.ndarray
    after: np.ndarray


def neighbours(ranks: dict[bytes, int], merges: np.ndarray, table: RankTable) -> Neighbours:
    token = {rank: piece for piece, rank in ranks.items()}

    @functools.cache
    def ends(of: int) -> list[int]:
        return [ranks[end] for at in range(len(token[of])) if (end := token[of][at:]) in ranks]

    @functools.cache
    def beginnings(of: int) -> list[int]:
        return [ranks[start] for at in range(len(token[of])) if (start := token[of][: at + 1]) in ranks]

    before = (number for left, right, merged in merges.tolist() for end in ends(left) for number in (end, right, merged))
    after = (number for left, right, merged in merges.tolist() for start in beginnings(right) for number in (left, start, merged))
    return Neighbours(table, *(np.fromiter(numbers, dtype=np.int32).reshape(-1, 3) for numbers in (before, after)))


def place_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(64 - BOUND_BITS)).astype(np.int64)


def least_ranks(rows: np.ndarray) -> np.ndarray:
    """A lower bound of the rank for every two tokens, by ``place_of``: rows that share a place leave the least of theirs."""
    least = np.full(1 << BOUND_BITS, 1 << RANK_BITS, dtype=np.int32)
    np.minimum.at(least, place_of(rows[:, 0], rows[:, 1]), rows[:, 2])
    return least


def beside_merger(known: Neighbours):
    """Function that merges, in words given by tokens and lengths, the pairs that nothing beside them can forestall.

    Such a pair comes before all that its tokens, or the merged one, could do with their neighbours, whatever these have
    grown to by then; so it may be made at once. The third result tells which words still have merges to make.
    """
    before, after = least_ranks(known.before), least_ranks(known.after)
    none = 1 << RANK_BITS

    def merged(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word = np.repeat(np.arange(len(lengths)), lengths)
        while True:
            slot = known.merges.slots[known.merges.base[tokens[:-1]] + tokens[1:]]
            at = np.flatnonzero((slot >> RANK_BITS == tokens[:-1] + 1) & (word[:-1] == word[1:]))
            left, right, new = tokens[at], tokens[at + 1], slot[at] & (none - 1)
            # Neighbours in the same word; at its ends the pair is its own, and not asked for.
            previous, following = np.maximum(at - 1, 0), np.minimum(at + 2, len(tokens) - 1)
            first, last = (at == 0) | (word[previous] != word[at]), (at + 2 > following) | (word[following] != word[at])
            previous, following = tokens[previous], tokens[following]
            sure = first | (new < before[place_of(previous, left)]) & (new < before[place_of(previous, new)])
            sure &= last | (new < after[place_of(right, following)]) & (new < after[place_of(new, following)])
            if not sure.any():
                still = np.zeros(len(lengths), dtype=bool)
                still[word[at]] = True
                return tokens, np.bincount(word, minlength=len(lengths)), still
            tokens = tokens.copy()
            tokens[at[sure]] = new[sure]
            tokens, word = np.delete(tokens, at[sure] + 1), np.delete(word, at[sure] + 1)

    return merged


def rank_frame(spark: SparkSession, table: RankTable) -> DataFrame:
    """The table as one row. As a literal it would be text in every plan, which the driver keeps for each job."""
    arrays = [pa.array(table.base, pa.int32()), pa.array(table.slots, pa.int64())]
    return spark.createDataFrame(pa.table([pa.ListArray.from_arrays([0, len(a)], a) for a in arrays], names=["base", "slots"]))


def fold_merges(tokens: Column, base: Column, slots: Column) -> Column:
    """Merge an array of token ids by rank, with higher-order functions."""
    none = 1 << RANK_BITS

    def merged_rank(left: Column, right: Column) -> Column:
        # The slot less its owner's mark is the merged token; another owner's slot, and an empty one, gives at least
        # ``none`` once the sign is masked. The last token has no right neighbour: null, which array_min skips.
        slot = F.get(slots, F.get(base, left) + right)
        return (slot - (left.cast("bigint") + 1) * none).bitwiseAND(F.lit((1 << 63) - 1))

    def step(state: Column, _: Column) -> Column:
        ids = state["ids"]
        ranked = F.zip_with(ids, F.slice(ids, F.lit(2), F.size(ids)), merged_rank)

        def merge(best: Column) -> Column:  # best: rank and place of the merge
            joined = F.concat(
                F.slice(ids, F.lit(1), best["at"] - 1), F.array(best["rank"].cast("int")), F.slice(ids, best["at"] + 2, F.size(ids))
            )
            return F.when(best["rank"] < F.lit(none), F.struct(joined.alias("ids"), F.lit(True).alias("open"))).otherwise(
                F.struct(ids.alias("ids"), F.lit(False).alias("open"))
            )

        # A transform over one element names the ranks, so they are computed once.
        found = F.transform(F.array(ranked), lambda r: F.struct(F.array_min(r).alias("rank"), F.array_position(r, F.array_min(r)).cast("int").alias("at")))
        return F.when(state["open"] & (F.size(ids) > 1), F.get(F.transform(found, merge), F.lit(0))).otherwise(
            F.struct(ids.alias("ids"), F.lit(False).alias("open"))
        )

    start = F.struct(tokens.alias("ids"), F.lit(True).alias("open"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1))), start, step, lambda s: s["ids"])


def fold_all(words: Column) -> Column:
    """Each word of an array merged, in a row with the arrays of ``rank_frame``. Transforms over one element read these once a row."""
    one = F.lit(0)
    return F.get(
        F.transform(
            F.array("base"),
            lambda base: F.get(F.transform(F.array("slots"), lambda slots: F.transform(words, lambda word: fold_merges(word, base, slots))), one),
        ),
        one,
    )


def byte_tokens(word: Column, ranks: dict[bytes, int]) -> Column:
    """The tokens of a word's single bytes."""
    first = F.split(F.lit(",".join(str(ranks[bytes([b])]) for b in range(256))), ",").cast("array<int>")
    letters = F.split(F.decode(word.cast("binary"), "ISO-8859-1"), "")  # one letter for each byte
    return F.transform(letters, lambda letter: F.get(first, F.ascii(letter)))


def encode_words(words: DataFrame, size: int, ranks: dict[bytes, int], table: DataFrame) -> DataFrame:
    """word and ids for each of about ``size`` distinct words (column ``word``) that are no tokens."""
    pile = F.pmod(F.xxhash64("word"), F.lit(1 + size // PILE_WORDS))
    piles = words.groupBy(pile.alias("pile")).agg(F.collect_list("word").alias("words"))
    tokens = F.transform("words", lambda word: byte_tokens(word, ranks))
    folded = piles.crossJoin(F.broadcast(table)).select("words", fold_all(tokens).alias("ids"))
    return folded.select(F.inline(F.arrays_zip("words", "ids"))).select(F.col("words").alias("word"), "ids")


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one word with a heap of neighbours, for long words."""
    if word in ranks:
        return [ranks[word]]
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    waiting = [(ranks[p], i, p) for i in range(len(word) - 1) if (p := word[i : i + 2]) in ranks]
    heapq.heapify(waiting)
    while waiting:
        _, i, pair = heapq.heappop(waiting)
        j = after[i] if parts[i] is not None else len(word)
        if parts[i] is None or j >= len(word) or parts[i] + parts[j] != pair:
            continue
        parts[i], parts[j], after[i] = pair, None, after[j]
        if after[i] < len(word):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(word) and (new := parts[k] + parts[after[k]]) in ranks:
                heapq.heappush(waiting, (ranks[new], k, new))
    return [ranks[p] for p in parts if p is not None]


def word_counts(docs: DataFrame, pattern: str, ranks: dict[bytes, int]) -> DataFrame:
    """word and the number of slices of texts that hold it, for words that are neither long nor tokens."""

    def counted(batches):
        split, tokens = splitter(pattern), text_tokens(ranks)[0]
        held, size = [], 0
        for batch in slices(batches):
            words = split(batch.column("text"))[0].unique()
            words = words.filter(pc.less_equal(pc.binary_length(words), LONG_WORD))
            held.append(words.filter(pc.is_null(pc.index_in(words, value_set=tokens))))
            size += len(held[-1])
            if size > HELD_WORDS:
                yield value_counts(held)
                held, size = [], 0
        if size:
            yield value_counts(held)

    return docs.select("text").mapInArrow(tidy(counted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def value_counts(parts: list[pa.Array]) -> pa.RecordBatch:
    counts = pc.value_counts(pa.concat_arrays(parts))
    return pa.record_batch([counts.field("values"), counts.field("counts")], names=["word", "n"])


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The words above the least count that at most ``size`` words reach, from a short histogram of counts."""
    step = F.floor(F.log2("n") * 16).cast("int")
    histogram = sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"])  # about 16 rows for each doubling
    total, least = 0, 1 << 30
    for row in histogram:
        total += row["count"]
        if total > size:
            break
        least = row["step"]
    return counts.where(step >= least).select("word")


@functools.cache
def char_kinds() -> np.ndarray:
    """By code point what the public pattern tells apart: 1 letter, 2 number, 3 white space, 0 any other."""
    kinds = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    chars = "".join(map(chr, range(len(kinds))))
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(name, chars):
            kinds[slice(*run.span())] = kind
    return kinds


def word_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The bytes at which the matches of ``public_tokenizers.PATTERN`` start, for UTF-8 ``data`` of texts that start at ``texts``."""
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    place = np.flatnonzero((data & 0xC0) != 0x80)  # of each character's first byte
    kind = char_kinds()[code]
    edge = np.zeros(len(code) + 3, dtype=bool)  # a text starts here, or all have ended
    edge[np.searchsorted(place, texts)] = True
    edge[len(code) :] = True
    start = edge[: len(code)].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # One blank belongs to the word behind it; of longer white space the last character stands by itself.
    inner = ~edge[1 : len(code)]
    start[1:] &= ~((kind[1:] != SPACE) & (code[:-1] == ord(" ")) & inner)
    start[:-1] |= (kind[:-1] == SPACE) & (kind[1:] != SPACE) & inner
    # 's 't 'm 'd 're 've 'll, where a match starts with the apostrophe.
    at = np.flatnonzero(start & (code == ord("'")))
    after = np.append(code, np.zeros(2, dtype=np.uint32))
    one = np.where(edge[at + 1], 0, after[at + 1])
    two = np.where(edge[at + 1] | edge[at + 2], 0, after[at + 2])
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.isin(one, [ord(c) for c in "rv"]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    at, size = at[short | long] + 1, np.where(short, 1, 2)[short | long]
    start[at] = False
    ends = at + size
    start[ends[ends < len(code)]] = True
    return place[start]


def public_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``splitter`` for the public pattern: the words stay where they lie, and only their ends are looked for, many texts at a time."""
    _, ends, data = texts.cast(pa.string()).buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = data or pa.py_buffer(b"")
    every = np.frombuffer(data, dtype=np.uint8)
    starts, first = [], 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, int(ends[first]) + PIECE_BYTES, "right")) - 1)
        if ends[first] < ends[last]:
            starts.append(int(ends[first]) + word_starts(every[ends[first] : ends[last]], ends[first : last + 1] - ends[first]))
        first = last
    offsets = np.concatenate([*starts, ends[-1:]]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), data])
    return words, np.searchsorted(offsets, ends)


def splitter(pattern: str):
    """Function from an array of texts to the array of all their words, and where the words of each text end (before them 0)."""
    if pattern == public_tokenizers.PATTERN:
        return public_words
    found = regex.compile(pattern)

    def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        words = [pa.array([m.group() for m in found.finditer(text.as_py())], pa.string()) for text in texts]
        return pa.concat_arrays([pa.array([], pa.string()), *words]), np.cumsum([0, *map(len, words)])

    return split


def handing_back(function, given):
    """The results one by one; while a result is read, what its making took is the system's again."""
    hand_back()
    for one in given:
        made = function(one)
        hand_back()
        yield made


def slices(batches):
    """Batches of at most ``SLICE_ROWS`` rows, which bound what a Python worker holds at once."""
    return (batch.slice(at, SLICE_ROWS) for batch in batches for at in range(0, batch.num_rows, SLICE_ROWS))


def offsets_of(lengths) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of words, one after the other."""
    return pc.binary_length(words).to_numpy().astype(np.int64), np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), dtype=np.uint8)


def text_of(token: bytes) -> str | None:
    try:
        return token.decode()
    except UnicodeDecodeError:
        return None


def text_tokens(ranks: dict[bytes, int]) -> tuple[pa.Array, np.ndarray]:
    """The tokens that are text, and their ids."""
    whole = [(text, rank) for token, rank in ranks.items() if (text := text_of(token)) is not None]
    return pa.array([text for text, _ in whole], pa.string()), np.array([rank for _, rank in whole], dtype=np.int32)


def read_dictionary(stream: bytes, ranks: dict[bytes, int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, offsets and ids of a broadcast Arrow stream, where they lie, and after them the tokens that are text."""
    coded = pa.ipc.open_stream(pa.py_buffer(stream)).read_all().combine_chunks()
    lists = coded.column("ids").chunk(0) if coded.num_rows else pa.array([], pa.list_(pa.int32()))
    words = coded.column("word").chunk(0) if coded.num_rows else pa.array([], pa.string())
    whole, numbers = text_tokens(ranks)
    words = pa.concat_arrays([words, whole])
    ends = lists.offsets.to_numpy()
    flat = np.concatenate([lists.values.to_numpy()[: ends[-1]], numbers])
    ends = np.concatenate([ends, ends[-1] + 1 + np.arange(len(whole), dtype=ends.dtype)])
    # One more offset: words without a place (-1) have length 0.
    return words, np.append(ends, 0), flat


def look_up(dictionary, ranks: dict[bytes, int], pattern: str, certain: RankTable, known_beside: Neighbours):
    """Function over Arrow batches: one row for each slice of texts, with their ids, their codes and the slice's rare words.

    A code is a token id or, below zero, the place (-1: first) of a word of the slice that is still to be folded. Rare
    words are the tokens of their bytes after the merges that are certain, in all words or beside their neighbours.
    """
    bytes_as_tokens = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    def looked_up(batches):
        known, offsets, flat = read_dictionary(dictionary.value, ranks)
        split, beside = splitter(pattern), beside_merger(known_beside)

        def coded(batch):
            # The words of a slice, each once, are looked up together.
            words, ends = split(batch.column("text"))
            words = words.dictionary_encode()
            place = pc.fill_null(pc.index_in(words.dictionary, value_set=known), -1).to_numpy().astype(np.int64)
            hand_back()  # the look-up's own table, greater than all that follows
            starts = offsets[place].astype(np.int64)
            lengths = offsets[place + 1] - starts
            unknown = np.flatnonzero(place < 0)
            strange = words.dictionary.take(pa.array(unknown))
            long = pc.greater(pc.binary_length(strange), LONG_WORD).to_numpy(zero_copy_only=False)
            heaped = [merge_bytes(word.encode(), ranks) for word in strange.filter(pa.array(long)).to_pylist()]
            sizes, data = bytes_of(strange.filter(pa.array(~long)))
            tokens, sizes, still = beside(*merge_certain(bytes_as_tokens[data], sizes, certain))
            # Words without further merges are done; others leave one code, and their tokens for the fold.
            word = np.repeat(np.arange(len(sizes)), sizes)
            rare, rare_sizes = tokens[still[word]], sizes[still]
            heads = np.cumsum(sizes) - sizes
            done = ~still[word]
            done[heads[still]] = True
            tokens[heads[still]] = -1 - np.arange(len(rare_sizes))
            given = np.concatenate([tokens[done], np.array([i for ids in heaped for i in ids], dtype=np.int32)])
            unknown = np.concatenate([unknown[~long], unknown[long]])
            lengths[unknown] = np.concatenate([np.where(still, 1, sizes), np.array([len(ids) for ids in heaped], dtype=np.int64)])
            starts[unknown] = len(flat) + np.cumsum(lengths[unknown]) - lengths[unknown]
            table = np.concatenate([flat, given.astype(np.int32)])
            which = words.indices.to_numpy()
            after = np.concatenate([[0], np.cumsum(lengths[which])])
            codes = table[np.repeat(starts[which] - after[:-1], lengths[which]) + np.arange(after[-1])]
            lists = [
                batch.column("doc_id"),
                pa.ListArray.from_arrays(pa.array(after[ends].astype(np.int32)), pa.array(codes, pa.int32())),
                pa.ListArray.from_arrays(offsets_of(rare_sizes), pa.array(rare, pa.int32())),
            ]
            return pa.record_batch([pa.ListArray.from_arrays(offsets_of([len(x)]), x) for x in lists], names=["doc_ids", "codes", "rare"])

        yield from handing_back(coded, slices(batches))

    return looked_up


def piece_array(ranks: dict[bytes, int]) -> pa.Array:
    """The bytes of each token by its id, and after them an empty piece, for ids that are no token."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 2)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pa.array(pieces, pa.binary())


def joined_pieces(ids: np.ndarray, ends: np.ndarray, pieces: pa.Array) -> pa.Array:
    """The bytes of each row's ids, which are ``ids[ends[row] : ends[row + 1]]``.

    Taken one after the other, the pieces lie in one buffer, in which only the rows' ends are to be marked.
    """
    none = len(pieces) - 1
    taken = pieces.take(pa.array(np.where((ids >= 0) & (ids < none), ids, none)))
    _, places, joined = taken.buffers()
    places = np.frombuffer(places, np.int32)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(places[ends].astype(np.int32)), joined or pa.py_buffer(b"")])


def splice(batches, pieces: pa.Array | None = None):
    """Put folded words in their places: doc_id, ids and the ids as little-endian unsigned 32-bit integers.

    With ``pieces`` the ids are decoded as well, to ``bytes``.
    """

    def row(parts):
        doc_ids, codes, words = parts
        codes, words = codes.values, words.values  # lists of ids, of texts and of words
        ends = codes.offsets.to_numpy()
        flat = codes.values.to_numpy()[ends[0] : ends[-1]]
        ends = ends - ends[0]
        at = np.flatnonzero(flat < 0)
        sizes = np.ones(len(flat), dtype=np.int64)
        if len(at):
            inner, starts, word = words.values.to_numpy(), words.offsets.to_numpy().astype(np.int64), -1 - flat[at].astype(np.int64)
            sizes[at] = starts[word + 1] - starts[word]
        after = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.repeat(flat, sizes).astype("<i4")
        if len(at):
            within = np.arange(int(sizes[at].sum())) - np.repeat(np.cumsum(sizes[at]) - sizes[at], sizes[at])
            ids[np.repeat(after[at], sizes[at]) + within] = inner[np.repeat(starts[word], sizes[at]) + within]
        places = after[ends].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(places), pa.array(ids))
        packed = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(places * np.int32(4)), pa.py_buffer(ids)])
        made = {"doc_id": doc_ids.values, "ids": lists, "packed": packed}
        if pieces is not None:
            made["bytes"] = joined_pieces(ids, places, pieces)
        return pa.record_batch(list(made.values()), names=list(made))

    rows = (parts for batch in batches for parts in zip(*[batch.column(name) for name in ("doc_ids", "codes", "folded")]))
    yield from handing_back(row, rows)


def encode(
    docs: DataFrame, vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN, dictionary_words: int = DICTIONARY_WORDS,
    with_bytes: bool = False,
) -> DataFrame:
    """doc_id, ids and packed ids of every whole text. ``vocabulary`` is the path of a rank file, read by the driver.

    ``with_bytes`` adds ``bytes``, to which the ids decode.
    """
    spark = docs.sparkSession
    ship_package(spark)
    ranks = load_ranks(vocabulary or public_tokenizers.path(VOCABULARY))
    texts = docs.select("doc_id", whole_text().alias("text"))
    counts = materialize(word_counts(texts, pattern, ranks), "bpe-words")
    pairs, size = pair_merges(ranks), max(ranks.values(), default=0) + 1
    whole_table = table_of(pairs, size)
    merges, certain, beside = rank_frame(spark, whole_table), table_of(certain_merges(pairs, size), size), neighbours(ranks, pairs, whole_table)
    del pairs
    hand_back_driver(spark)
    frequent = most_frequent(counts, dictionary_words)
    coded = materialize(encode_words(frequent, dictionary_words, ranks, merges), "bpe-dictionary").toArrow()
    stream = pa.BufferOutputStream()
    with pa.ipc.new_stream(stream, coded.schema) as writer:
        writer.write_table(coded)
    del coded
    packed = stream.getvalue()
    del stream
    payload = packed.to_pybytes()
    del packed
    dictionary = spark.sparkContext.broadcast(payload)  # at most dictionary_words
    del payload
    hand_back_driver(spark)  # here, too, Python and the JVM share one memory
    found = texts.mapInArrow(tidy(look_up(dictionary, ranks, pattern, certain, beside)), "doc_ids array<long>, codes array<array<int>>, rare array<array<int>>")
    parts = found.crossJoin(F.broadcast(merges)).select("doc_ids", "codes", fold_all(F.col("rare")).alias("folded"))
    schema = "doc_id long, ids array<int>, packed binary" + (", bytes binary" if with_bytes else "")
    pieces = piece_array(ranks) if with_bytes else None

    def spliced(batches):
        return splice(batches, pieces)

    return parts.mapInArrow(tidy(spliced), schema)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The bytes of each row's ids: all other columns and ``bytes``. Null ids give null, ids that are no token nothing."""
    ship_package(encoded.sparkSession)
    pieces = piece_array(load_ranks(vocabulary or public_tokenizers.path(VOCABULARY)))
    given = encoded.drop("bytes")

    def decoded(batches):
        for batch in slices(batches):
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy().astype(np.int64)
            flat = pc.fill_null(ids.values, -1).to_numpy()[ends[0] : ends[-1]]
            joined = joined_pieces(flat, ends - ends[0], pieces)
            joined = pc.if_else(ids.is_valid(), joined, pa.scalar(None, pa.binary()))
            yield pa.record_batch([*batch.columns, joined], names=[*batch.schema.names, "bytes"])

    return given.mapInArrow(tidy(decoded), StructType([*given.schema.fields, StructField("bytes", BinaryType())]))


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, number of tokens and the digests of the ids and of the decoded bytes."""
    return encode(docs, vocabulary, with_bytes=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
