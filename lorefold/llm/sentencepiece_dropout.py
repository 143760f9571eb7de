"""Encoding by the merges of a SentencePiece BPE model with seeded merge-dropout, and lossless decoding.

Contract
* With dropout 0 the ids are the library's. With dropout p every candidate merge that reaches the head
  of the agenda is skipped if a hash keyed by seed, row (id and text), the word's position in the text,
  word, place and merged piece falls below p: every occurrence of a word draws its own skips, and the same
  key always gives the same ids, whatever the partitioning.
* decode() gives back exactly the text: blanks travel as the model's blank mark, and a mark that stands
  in the text itself as its bytes (the one case where dropout 0 differs from the library).
* Null and empty texts have no ids. Rows that repeat an id are encoded each; extra columns pass.

No piece of the model has a blank mark after another character, so merges never pass from one word to
the next: texts are cut before blanks. Agendas are processed side by side in arrays, a row a word, where
every step takes the best candidate of each row. A batch's distinct words run once without skips; an
occurrence whose draws would skip none of its word's merges has these ids, and each other occurrence runs
its own agenda with its own skips.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, pieces, ragged, starts, sum_by_row, table

BLANK = "▁"
#: Bytes of texts encoded at once, words of texts that are put together, and agendas that run side by side.
TEXT_AT_ONCE, SLICE_WORDS, LANES = 3 << 20, 250_000, 8_192
MASK = (1 << 64) - 1
#: Characters up to which agendas run in arrays, by the width of these.
WIDTHS = (8, 12, 16, 24, 32, 64)
#: Rank of no merge, and a slot of the table of merges that holds none.
NEVER, FREE = np.int32(2**31 - 1), np.int64(-1)
_loaded: dict = {}


def skipped(key: int, place: int, piece: int, limit: int) -> bool:
    """Whether the keyed hash of a candidate merge falls below limit / 2**32."""
    h = (key + place * 0x9E3779B97F4A7C15 + piece * 0xC2B2AE3D27D4EB4F) * 0xD6E8FEB86659FD93 & MASK
    return ((h ^ h >> 32) * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFF) < limit


def occurrence_keys(row: np.ndarray, position: np.ndarray, seed: int) -> np.ndarray:
    """Key of the word at each position of the row with that hash."""
    h = (row.astype(np.int64).view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 & MASK)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(32)) + position.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


class Model:
    """Pieces of a model file by id, and ranks of merges."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [library.id_to_piece(i) for i in range(library.vocab_size())]
        byte = [library.is_byte(i) for i in range(len(self.pieces))]
        special = [library.is_control(i) or library.is_unknown(i) for i in range(len(self.pieces))]
        self.id_of = {p: i for i, p in enumerate(self.pieces) if not byte[i] and not special[i]}
        self.rank = {p: -library.get_score(i) for p, i in self.id_of.items()}
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if byte[i]}
        if len(self.byte_id) != 256 or any(BLANK in p.lstrip(BLANK) for p in self.pieces):
            raise ValueError("a BPE model with byte fallback is needed, whose pieces have blank marks at their start only")
        # For decoding: each id's bytes, a blank mark as a blank.
        self.decoded = [bytes([int(p[3:5], 16)]) if byte[i] else b"" if special[i] else p.replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]
        self._tables()

    def _tables(self) -> None:
        """Ids of characters, ids by rank, and a hash table from pairs of ids to the rank of their merge."""
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        # Words with several blanks are run one by one; their pieces may share a score.
        ordered = sorted((p for p in self.id_of if not p.startswith(2 * BLANK)), key=self.rank.get)
        self.by_rank = np.array([self.id_of[p] for p in ordered], np.int32)
        pairs, scores = {}, set()
        for r, p in enumerate(ordered):
            for k in range(1, len(p)):
                a, b = self.id_of.get(p[:k]), self.id_of.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = r
                    scores.add((self.rank[p], p))
        if len({score for score, _ in scores}) < len(scores):
            raise ValueError("merges of equal score have no order")
        self.table_bits = max(4, (4 * len(pairs)).bit_length())
        self.keys, self.values = np.full(1 << self.table_bits, FREE), np.full(1 << self.table_bits, NEVER)
        for q, r in pairs.items():
            at = (q * 0x9E3779B97F4A7C15 & MASK) >> 64 - self.table_bits
            while self.keys[at] != FREE:
                at = at + 1 & (1 << self.table_bits) - 1
            self.keys[at], self.values[at] = q, r

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids; NEVER for none, or where either id is negative."""
        q = np.where((left < 0) | (right < 0), np.int64(-2), left.astype(np.int64) << 20 | right)
        at = (q.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.table_bits)).astype(np.int64)
        found = self.keys[at]
        out = np.where(found == q, self.values[at], NEVER)
        onward = np.flatnonzero((found != q) & (found != FREE))
        while len(onward):
            at[onward] = at[onward] + 1 & (1 << self.table_bits) - 1
            found = self.keys[at[onward]]
            hit = found == q[onward]
            out[onward[hit]] = self.values[at[onward[hit]]]
            onward = onward[~hit & (found != FREE)]
        return out

    def encode_word(self, word: str, dropout: float, key: int) -> list[int]:
        """ids of a word that carries its blank marks."""
        key ^= zlib.crc32(word.encode("utf-8", "surrogatepass")) << 16
        return self.ids_of(self._merge(word, int(dropout * (1 << 32)), key))

    def ids_of(self, symbols: list[str]) -> list[int]:
        out, id_of = [], self.id_of
        for s in symbols:
            i = id_of.get(s)
            if i is not None:
                out.append(i)
            else:
                out += [self.byte_id[b] for b in s.encode()]
        return out

    def _merge(self, word: str, limit: int, key: int) -> list[str]:
        """One word's agenda as a heap, for strings of any length and characters."""
        rank, n = self.rank, len(word)
        symbols, before, after = list(word), list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(r, i, i + 1, word[i : i + 2]) for i in range(n - 1) if (r := rank.get(word[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, piece = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or after[i] != j or symbols[i] + symbols[j] != piece:
                continue
            if limit and skipped(key, i, self.id_of[piece], limit):
                continue
            symbols[i], symbols[j] = piece, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(piece + symbols[k])
                if r is not None:
                    heapq.heappush(agenda, (r, i, k, piece + symbols[k]))
            k = before[i]
            if k >= 0:
                r = rank.get(symbols[k] + piece)
                if r is not None:
                    heapq.heappush(agenda, (r, k, i, symbols[k] + piece))
        return [s for s in symbols if s]

    def encode_text_word(self, word: str, dropout: float, key: int) -> list[int]:
        """ids of a text's word, its leading blanks as blanks; marks in the text itself become bytes."""
        if BLANK not in word:
            return self.encode_word(word.replace(" ", BLANK), dropout, key)
        out = []
        for i, part in enumerate(word.split(BLANK)):
            if i:
                out += [self.byte_id[b] for b in BLANK.encode()]
            if part:
                out += self.encode_word(part.replace(" ", BLANK), dropout, key)
        return out


def model(path: str) -> Model:
    if path not in _loaded:
        _loaded[path] = Model(path)
    return _loaded[path]


def cut_words(text: str) -> list[str]:
    """A text with the blank that stands before it, cut before each run of blanks."""
    out, blanks = [], 0
    for part in text.split(" "):
        blanks += 1
        if part:
            out.append(" " * blanks + part)
            blanks = 0
    if blanks:
        out.append(" " * blanks)
    return out


def encode_texts(m: Model, texts: pa.Array, row: np.ndarray, dropout: float, seed: int, first: int = 0) -> pa.ListArray:
    """ids of each text with its row's hash, its words counted from first. Texts with runs of blanks, or blanks at an end, are cut one by one; others all at once."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    odd = np.asarray(pc.match_substring_regex(texts, "^$|  | $|^ "))
    if not odd.any():
        return _encode(m, *_cut_plain(texts), row, dropout, seed, first)
    rows = [cut_words(t) if t else [] for t in texts.filter(pa.array(odd)).to_pylist()]
    cut = pa.array([w for r in rows for w in r], pa.large_string()), np.fromiter(map(len, rows), np.int64, len(rows)), ""
    both = [_encode(m, *_cut_plain(texts.filter(pa.array(~odd))), row[~odd], dropout, seed, first), _encode(m, *cut, row[odd], dropout, seed, first)]
    order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
    return pa.concat_arrays(both).take(pa.array(order))


def _cut_plain(texts: pa.Array) -> tuple[pa.Array, np.ndarray, str]:
    parts = pc.split_pattern(texts, " ")
    return parts.flatten(), np.asarray(pc.list_value_length(parts)).astype(np.int64), " "


def merge_rows(m: Model, ids: np.ndarray, key: np.ndarray, limit: int, merges: list | None = None) -> None:
    """Run the agenda of each row of ids of characters (-1 beyond its end) in place; what is merged away becomes -1.
    Merges done are added to merges as (row, place, piece)."""
    n, width = ids.shape
    rank = np.full((n, width), NEVER, np.int32)
    rank[:, :-1] = m.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
    after, before = np.tile(np.arange(1, width + 1), (n, 1)), np.tile(np.arange(-1, width - 1), (n, 1))
    ids_, rank_, after_, before_ = ids.reshape(-1), rank.reshape(-1), after.reshape(-1), before.reshape(-1)
    a, b, c, shift = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 32))
    row = np.arange(n)
    while len(row):
        place = rank[row].argmin(1)
        best = rank_[row * width + place]
        going = best != NEVER
        row, place, piece = row[going], place[going], m.by_rank[best[going]]
        done, at, p = row, row * width + place, place
        if limit:
            h = (key[row] + place.astype(np.uint64) * a + piece.astype(np.uint64) * b) * c
            skip = (h ^ h >> shift) * c >> shift < np.uint64(limit)
            rank_[at[skip]] = NEVER
            done, at, p, piece = row[~skip], at[~skip], place[~skip], piece[~skip]
        if merges is not None:
            merges.append((done, p, piece))
        base = done * width
        second = base + after_[at]
        following = after_[second]
        ids_[at], ids_[second], rank_[second], after_[at] = piece, -1, NEVER, following
        some = following < width
        before_[(base + following)[some]] = p[some]
        rank_[at] = m.ranks(piece, np.where(some, ids_[base + np.minimum(following, width - 1)], -1))
        some = before_[at] >= 0
        prior = (base + before_[at])[some]
        rank_[prior] = m.ranks(ids_[prior], piece[some])


def _rows(chars: np.ndarray, first: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    out = np.full((len(first), width), -1, np.int32)
    out.reshape(-1)[ragged(np.arange(len(first)) * width, size)] = chars[ragged(first, size)]
    return out


def _by_width(size: np.ndarray):
    """(width, places) of words that fit it, LANES at most at once."""
    for low, width in zip((0, *WIDTHS), WIDTHS):
        at = np.flatnonzero((size > low) & (size <= width))
        for i in range(0, len(at), LANES):
            yield width, at[i : i + LANES]


class Words:
    """Distinct words of a batch: ids of their characters, and their merges and ids without skips."""

    def __init__(self, m: Model, words: list[str]):
        self.words = words
        marked = [w.replace(" ", BLANK) for w in words]
        size = np.fromiter(map(len, marked), np.int64, len(words))
        self.first, self.size = starts(size)[:-1], size
        self.chars = m.char_ids[np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)]
        odd = sum_by_row((self.chars < 0).astype(np.int64), size) > 0
        # Words of characters without a piece, with several blanks or a mark of their own, or longer than arrays are run one by one.
        self.plain = ~odd & (size <= WIDTHS[-1]) & np.fromiter((BLANK not in w and not w.startswith("  ") for w in words), bool, len(words))
        self.crc = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in marked), np.uint64, len(words))
        ids, n_ids, merges, no_key = [], np.zeros(len(words), np.int64), [], np.zeros(LANES, np.uint64)
        usable, order = np.where(self.plain, size, 0), []
        for width, at in _by_width(usable):
            rows, done = _rows(self.chars, self.first[at], size[at], width), []
            merge_rows(m, rows, no_key, 0, done)
            left = rows >= 0
            n_ids[at] = left.sum(1)
            ids.append(rows[left])
            order.append(at)
            merges += [(at[row], place, piece) for row, place, piece in done]
        # What comes by width is brought into the words' order.
        none = np.zeros(0, np.int64)
        order = np.concatenate([none, *order])
        by_width = starts(n_ids[order])[:-1]
        at = np.zeros(len(words), np.int64)
        at[order] = by_width
        self.n_ids, self.first_id, self.ids = n_ids, at, np.concatenate([none.astype(np.int32), *ids])
        word, self.place, self.piece = (np.concatenate([none, *(x[i] for x in merges)]) for i in range(3))
        sort = np.argsort(word, kind="stable")
        self.place, self.piece = self.place[sort].astype(np.uint64), self.piece[sort].astype(np.uint64)
        self.n_merges = np.bincount(word, minlength=len(words))
        self.first_merge = starts(self.n_merges)[:-1]

    def any_skipped(self, code: np.ndarray, key: np.ndarray, limit: int) -> np.ndarray:
        """Whether an occurrence's draws skip one of its word's merges."""
        n, a, b, c, shift = self.n_merges[code], *(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 32))
        at = ragged(self.first_merge[code], n)
        h = (np.repeat(key, n) + self.place[at] * a + self.piece[at] * b) * c
        return sum_by_row(((h ^ h >> shift) * c >> shift < np.uint64(limit)).astype(np.int64), n) > 0


def _encode(m: Model, flat: pa.Array, per_text: np.ndarray, lead: str, row: np.ndarray, dropout: float, seed: int, first: int) -> pa.ListArray:
    """ids of texts given as all their words in a row (lead stands before each) and each text's number of them."""
    if not per_text.sum():
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(per_text) + 1, np.int32)), pa.array([], pa.int32()))
    coded, limit = flat.dictionary_encode(), int(dropout * (1 << 32))
    index = np.asarray(coded.indices).astype(np.int64)
    words = Words(m, [lead + w for w in coded.dictionary.to_pylist()])
    edges, per_slice = starts(per_text), []
    # Texts are put together some at a time.
    at = np.searchsorted(edges, np.arange(0, edges[-1], SLICE_WORDS)).tolist()
    bounds = [*dict.fromkeys(at), len(per_text)]
    for a, b in zip(bounds, bounds[1:]):
        code = index[edges[a] : edges[b]]
        key = occurrence_keys(np.repeat(row[a:b], per_text[a:b]), first + ragged(np.zeros(b - a, np.int64), per_text[a:b]), seed)
        own = key ^ words.crc[code] << np.uint64(16)
        plain, size = words.plain[code], words.n_ids[code]
        skipping = np.flatnonzero(plain & words.any_skipped(code, own, limit))
        parts = []
        for width, i in _by_width(words.size[code[skipping]]):
            i = skipping[i]
            rows = _rows(words.chars, words.first[code[i]], words.size[code[i]], width)
            merge_rows(m, rows, own[i], limit)
            left = rows >= 0
            size[i] = left.sum(1)
            parts.append((i, rows[left]))
        alone = {i: m.encode_text_word(words.words[code[i]], dropout, int(key[i])) for i in np.flatnonzero(~plain).tolist()}
        size[list(alone)] = [len(x) for x in alone.values()]
        total, ids = starts(size), np.zeros(int(size.sum()), np.int32)
        same = plain.copy()
        same[skipping] = False
        ids[ragged(total[:-1][same], size[same])] = words.ids[ragged(words.first_id[code[same]], size[same])]
        for i, got in parts:
            ids[ragged(total[i], size[i])] = got
        for i, got in alone.items():
            ids[total[i] : total[i + 1]] = got
        per_slice.append(pa.ListArray.from_arrays(pa.array(total[edges[a : b + 1] - edges[a]].astype(np.int32)), pa.array(ids)))
    return pa.concat_arrays(per_slice)


def decode_ids(m: Model, ids) -> str:
    """The text of a row's ids."""
    data = b"".join(map(m.decoded.__getitem__, ids)).decode("utf-8", "replace")
    return data[1:]


def encode(documents: DataFrame, path: str, dropout: float, seed: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """documents with ids, and lossless: whether decoding them gave back the text."""
    named = documents.drop("ids", "lossless")
    row = F.xxhash64(F.col(key).cast("string"), F.col(text))

    @F.arrow_udf("struct<ids:array<int>,lossless:boolean>")
    def encoded(texts: pa.Array, row: pa.Array) -> pa.Array:
        m, ids, same = model(path), [], []
        batch = pa.RecordBatch.from_arrays([texts, row], ["text", "row"])
        for part in pieces([batch], limit=TEXT_AT_ONCE):
            rows = encode_texts(m, part.column(0), part.column(1).to_numpy(zero_copy_only=False), dropout, seed)
            edge, flat = rows.offsets.to_pylist(), rows.values.to_numpy()
            for i, want in enumerate(part.column(0)):
                same.append(decode_ids(m, flat[edge[i] : edge[i + 1]].tolist()) == (want.as_py() or ""))
            ids.append(rows)
            pa.default_memory_pool().release_unused()
        flat = pa.concat_arrays(ids) if ids else pa.array([], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([flat, pa.array(same, pa.bool_())], ["ids", "lossless"])

    (both,) = free_names(named, "_encoded")
    return named.withColumn(both, encoded(F.col(text), row)).select(*named.columns, f"{both}.ids", f"{both}.lossless")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """encoded with decoded: the text of its ids; null ids give null."""

    @F.arrow_udf("string")
    def text(rows: pa.Array) -> pa.Array:
        m = model(path)
        return pa.array([None if r is None else decode_ids(m, r) for r in rows.to_pylist()], pa.string())

    return encoded.withColumn("decoded", text(F.col(ids)))


def op5_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), dropout=0.1, seed=7)
    return out.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), F.size("ids").cast("bigint").alias("n_tokens"), "lossless", F.xxhash64("ids").alias("ids_hash"))
