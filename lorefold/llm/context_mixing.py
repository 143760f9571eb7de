"""Language-model scores by online logistic mixing of hashed-context bit predictors.

Contract
* Learns from the texts whose crc32(id as text) mod 7 is not 2, and scores every whole text. Null counts
  as empty (its score is that of the end alone); rows that repeat an id learn and are scored each; extra
  columns pass; without any text to learn from every predictor is undecided and c, N and V are 0.
* score is the log10 probability of the text's bytes and its end; bits its bits, bits_per_byte by bytes
  (null for no bytes). base_score, n_tokens, n_known and train_tokens follow the lower-cased words and one
  end per text, each token at log10((c + 1) / (N + V + 1)).

The model. A text is cut at blanks. Each word and the blank after it are coded byte by byte by the bits
of a Huffman code of the corpus's bytes after the byte before; after a blank one more bit says whether the text ends. Of every
bit the contexts are the bytes before it within the word: the last 1, 2, 3 and 4, and all; for a word's
first HEAD bytes also all of them with the last two bytes of the word before. Each context with the place
in the code is hashed into a table of counts of zeros and ones, summed over the corpus, which gives a
logit. An online mixer adds the six logits and a constant with weights that two gates choose: a row by how
often the longest context within the word was met, plus a row by how sure the logit across words is. All
start equal, and every weight of every row learns from the bits already seen of the text: after each STEP
bits the rows are refined, and so is a second stage that maps the mixed logit to the frequencies met. A
text keeps what it learnt to its end: it is coded in chunks of words (a step ends with its chunk) that
hand weights and map on, and texts of any length are coded side by side in arrays.

The corpus is gathered by shuffles: counts of words and of pairs of ends and beginnings, from these counts of tokens and of contexts. The
tables of contexts grow with the distinct words and pairs that are counted, up to MOST_BITS (a table is
broadcast: 3 bytes a slot); frequent tokens are broadcast too, up to FREQUENT. All others meet their
counts in a join.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, cut, lower_ascii, pieces, ragged, split_words, starts, sum_by_row, table

LAST = (1, 2, 3, 4)
WITHIN = 5
#: Bits of the tables of the last 1, 2, 3 and 4 bytes at most (there are only so many), and of any table at least and at most.
LAST_BITS, LEAST_BITS, MOST_BITS = (16, 18, 20, 22), 12, 24
HEAD = 3
#: Distinct words whose decisions are laid out at once.
WORDS_AT_ONCE = 4_096
STEP = 64
#: Words of a text that are coded together; a longer text is coded in such chunks one after the other, so its length takes no memory.
CHUNK_WORDS = 1024
#: Text that a task reads for counts and scores at once, decisions it codes side by side, and words or pairs whose contexts it counts at once.
TEXT_AT_ONCE, SCORED_AT_ONCE, DECISIONS_AT_ONCE, COUNTED_AT_ONCE = 2 << 20, 4 << 20, 1 << 21, 16_384
MASK = (1 << 64) - 1
#: Tokens of known count that are broadcast at most (about 20 bytes each).
FREQUENT = 200_000
#: Words a task turns into tables; the tables are added up FAN_IN at a time.
WORDS_PER_TASK, FAN_IN = 1_500_000, 16
#: Slots of a table that travel together.
PART_BITS = 16
LOGIT_UNIT, PRIOR, RATE, MAP_RATE = 1 / 1500, 0.3, 0.01, 0.02
#: Counts from which the longest context within the word is surer by a gate, and the logit across words.
SURE, ACROSS_SURE = (1, 3, 10, 100, 1000), (1, 50)
GATES = len(SURE) + 1, len(ACROSS_SURE) + 1
#: Columns of a decision: the logits, the constant, and a tag of both gates and the bit.
CONSTANT, TAG, COLUMNS = WITHIN + 1, WITHIN + 2, WITHIN + 3
#: Which rows of weights the gates of a tag choose.
ROWS = np.array([[i == a for i in range(GATES[0])] + [i == b for i in range(GATES[1])] for a in range(GATES[0]) for b in range(GATES[1])], np.float32)
#: Of a tag all its rows but the second gate's first: that one learns what the others of its gate leave of the first gate's sum.
CHOSEN = np.ascontiguousarray(np.delete(ROWS, GATES[0], axis=1))
GATHER = np.insert(np.eye(sum(GATES) - 1, dtype=np.float32), GATES[0], [1] * GATES[0] + [-1] * (GATES[1] - 1), axis=0)
#: Starting weight of every logit in the rows of the first gate; all else starts from 0.
EQUAL = 0.3
START = np.zeros((sum(GATES), COLUMNS), np.float32)
START[: GATES[0], :CONSTANT] = EQUAL
BUCKETS, BUCKET_WIDTH = 33, 0.5
#: The end of the word before the first.
NO_WORD = b"\0\0\0"
PRIMES = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], np.uint64)
SPREAD, STRIDE, FINISH = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def table_bits(n_words: int, n_pairs: int) -> tuple[int, ...]:
    """Width of each context's table by the distinct words and pairs counted: four slots a word (of its own), one a pair."""
    fit = lambda n: int(np.clip(np.ceil(np.log2(max(2, n))), LEAST_BITS, MOST_BITS))
    return *(min(most, max(LEAST_BITS, fit(4 * n_words))) for most in LAST_BITS), fit(4 * n_words), fit(n_pairs)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A code for each byte before (row 0: none): where each byte's (node, bit) steps begin in the list of all, and that list as two arrays."""
    nodes, bits, size = [], [], []
    overall = counts.sum(0) + 1
    overall = overall / overall.sum()
    for row in counts:
        # Rare rows lean on all bytes together; every byte has a code.
        agenda = [(float(w), s) for s, w in enumerate(row + overall)]
        heapq.heapify(agenda)
        up, new = {}, 256
        while len(agenda) > 1:
            (n0, a), (n1, b) = heapq.heappop(agenda), heapq.heappop(agenda)
            up[a], up[b] = (new, 0), (new, 1)
            heapq.heappush(agenda, (n0 + n1, new))
            new += 1
        for s in range(256):
            path = []
            while s in up:
                path.append(up[s])
                s = up[s][0]
            size.append(len(path))
            nodes += [n - 256 for n, _ in reversed(path)]
            bits += [b for _, b in reversed(path)]
    return starts(np.array(size)), np.array(nodes, np.int64), np.array(bits, np.int8)


def decisions(words: pa.Array, code, widths, blank: bool = True):
    """Of each decision of each word (a blank follows, if asked): table slots by context within the word, bit,
    hash of all bytes before, whether it is of the first HEAD bytes; and where each word's decisions begin."""
    begin, nodes, bits = code
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    size = np.diff(offsets) + blank
    edge = starts(size)
    data = raw
    if blank:
        data = np.full(edge[-1], 32, np.uint8)
        inside = np.ones(edge[-1], bool)
        inside[edge[1:] - 1] = False
        data[inside] = raw
    place = np.arange(edge[-1]) - np.repeat(edge[:-1], size)
    b = data.astype(np.uint64) + np.uint64(1)
    last = [np.where(place >= k, np.concatenate([np.zeros(k, np.uint64), b[:-k]])[: len(b)], np.uint64(0)) for k in range(1, 5)]
    contexts, h = [], np.zeros(len(b), np.uint64)
    for k in range(1, max(LAST) + 1):
        h = h * np.uint64(0x2F0B4C47) + last[k - 1]
        if k in LAST:
            contexts.append(h)
    # The hash of all bytes before: words advance together, place by place.
    whole, at = np.zeros(len(b), np.uint64), edge[:-1].copy()
    alive = np.flatnonzero(size > 1)
    for _ in range(int(size.max(initial=1)) - 1):
        p = at[alive]
        whole[p + 1] = whole[p] * STRIDE + b[p] * SPREAD
        at[alive] += 1
        alive = alive[at[alive] < edge[alive + 1] - 1]
    contexts.append(whole)
    coded = last[0].astype(np.int64) * 256 + data
    steps = np.diff(begin)[coded]
    from_byte = np.repeat(np.arange(len(data)), steps)
    step = ragged(begin[coded], steps)
    node = nodes.take(step).astype(np.uint64) * STRIDE
    slots = []
    for k in range(WITHIN):
        mixed = contexts[k] * SPREAD
        mixed = (mixed ^ (mixed >> np.uint64(29))) * PRIMES[k]
        key = mixed.take(from_byte)
        key += node
        key *= FINISH
        slots.append((key >> np.uint64(64 - widths[k])).view(np.int64))
    return slots, bits.take(step), key, (place < HEAD).take(from_byte), starts(steps)[edge]


def across_slots(key: np.ndarray, ends: np.ndarray, widths) -> np.ndarray:
    """Slots of decisions by the hash of the bytes before and that of the end of the word before."""
    return ((((key >> np.uint64(20)) ^ ends) * SPREAD) >> np.uint64(64 - widths[WITHIN])).astype(np.int64)


def end_hashes(ends: pa.Array) -> np.ndarray:
    coded = ends.dictionary_encode()
    return np.array([zlib.crc32(e) * 0x9E3779B97F4A7C15 & MASK for e in coded.dictionary.to_pylist()] or [0], np.uint64)[np.asarray(coded.indices)]


def before(values: np.ndarray, per_text: np.ndarray, first) -> np.ndarray:
    """Of a value per word, that of the word before, and first for each text's first word."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[starts(per_text)[:-1][per_text > 0]] = first
    return out


# Gathering from the corpus


def blank_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between blanks in a row (empty ones too), and each text's number of them."""
    parts = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), " ")
    return parts.flatten(), np.asarray(pc.list_value_length(parts)).astype(np.int64)


def _count_words(batches):
    """(word, null, n), and for pairs of neighbours (first HEAD bytes of the word and its blank, end of the one before, n)."""
    for batch in pieces(batches, limit=TEXT_AT_ONCE):
        words, per_text = blank_words(batch.column(0))
        coded = words.dictionary_encode()
        own, index = coded.dictionary.cast(pa.large_binary()), np.asarray(coded.indices).astype(np.int64)
        yield pa.RecordBatch.from_arrays([own.cast(pa.binary()), pa.nulls(len(own), pa.binary()), pa.array(np.bincount(index, minlength=len(own)))], ["word", "end", "n"])
        follow = pa.scalar(b" ", pa.large_binary())
        heads = pc.binary_slice(pc.binary_join_element_wise(own, follow, pa.scalar(b"", pa.large_binary())), 0, HEAD).dictionary_encode()
        ends = pc.binary_slice(own, -2, None).dictionary_encode()
        head = np.asarray(heads.indices).astype(np.int64)[index]
        end = before(np.asarray(ends.indices).astype(np.int64)[index], per_text, len(ends.dictionary))
        pair, n = np.unique(end * len(heads.dictionary) + head, return_counts=True)
        names = pa.concat_arrays([ends.dictionary, pa.array([NO_WORD], pa.large_binary())])
        pick = lambda values, at: values.take(pa.array(at)).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([pick(heads.dictionary, pair % len(heads.dictionary)), pick(names, pair // len(heads.dictionary)), pa.array(n)], ["word", "end", "n"])


def _count_bytes(batches):
    """(256 * (byte before + 1) + byte, n); 0 stands for no byte before, and a blank follows each word."""
    total = np.zeros(257 * 256)
    for batch in batches:
        n = np.asarray(batch.column(1))
        words = batch.column(0).to_pylist()
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        data = np.frombuffer(b" ".join([*words, b""]), np.uint8).astype(np.int64)
        prior = np.concatenate([[0], data[:-1] + 1])
        prior[starts(size)[:-1]] = 0
        total += np.bincount(prior * 256 + data, np.repeat(n, size), minlength=257 * 256)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], ["pair", "n"])


def _count_contexts(code, widths):
    def count(batches):
        tables = [np.zeros((1 << width) * 2, np.float32) for width in widths]
        for batch in batches:
            for a in range(0, batch.num_rows, COUNTED_AT_ONCE):
                part = batch.slice(a, COUNTED_AT_ONCE)
                alone = np.asarray(pc.is_null(part.column(1)))
                for kind in (True, False):
                    rows = part.filter(pa.array(alone == kind))
                    if not rows.num_rows:
                        continue
                    slots, bits, key, _, edge = decisions(rows.column(0), code, widths, blank=kind)
                    weight = np.repeat(np.asarray(rows.column(2)).astype(np.float32), np.diff(edge))
                    if kind:
                        for k in range(WITHIN):
                            np.add.at(tables[k], slots[k] * 2 + bits, weight)
                    else:
                        np.add.at(tables[WITHIN], across_slots(key, np.repeat(end_hashes(rows.column(1).cast(pa.large_binary())), np.diff(edge)), widths) * 2 + bits, weight)
        part_id = TaskContext.get().partitionId()
        for k, counts in enumerate(tables):
            for p in range(0, len(counts), 2 << PART_BITS):
                yield pa.RecordBatch.from_pylist([{"k": k, "p": p >> (PART_BITS + 1), "source": part_id, "counts": pack(counts[p : p + (2 << PART_BITS)])}])

    return count


def pack(counts: np.ndarray) -> bytes:
    """Length, number of those that aren't 0, and these with their places; or all, where that is shorter."""
    at = np.flatnonzero(counts)
    sparse = len(at) * 8 < counts.nbytes
    head = np.array([len(counts), len(at) if sparse else -1], np.int64).tobytes()
    return head + (at.astype(np.uint32).tobytes() + counts[at].tobytes() if sparse else counts.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    size, n = np.frombuffer(raw, np.int64, 2).tolist()
    if n < 0:
        return np.frombuffer(raw, np.float32, offset=16)
    out = np.zeros(size, np.float32)
    out[np.frombuffer(raw, np.uint32, n, 16)] = np.frombuffer(raw, np.float32, n, 16 + 4 * n)
    return out


def _add(batches):
    """Sums of neighbouring rows of the same (k, p, source); rows arrive sorted by these."""
    key, total = None, None
    for batch in batches:
        for x in batch.to_pylist():
            counts = unpack(x["counts"])
            if (x["k"], x["p"], x["source"]) == key:
                total = total + counts
                continue
            if key is not None:
                yield pa.RecordBatch.from_pylist([dict(zip(("k", "p", "source"), key)) | {"counts": pack(total)}])
            key, total = (x["k"], x["p"], x["source"]), counts
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(("k", "p", "source"), key)) | {"counts": pack(total)}])


def _logits(batches):
    for batch in batches:
        for x in batch.to_pylist():
            n = unpack(x["counts"]).reshape(-1, 2)
            logit = np.rint(np.log((n[:, 1] + PRIOR) / (n[:, 0] + PRIOR)) / LOGIT_UNIT)
            sure = np.digitize(n.sum(1), SURE) if x["k"] < WITHIN else np.digitize(n.sum(1), ACROSS_SURE)
            yield pa.RecordBatch.from_pylist([{"k": x["k"], "p": x["p"], "logits": np.clip(logit, -32767, 32767).astype(np.int16).tobytes(), "sure": sure.astype(np.uint8).tobytes()}])


TABLE_ROWS = "k long, p long, source long, counts binary"


def learn(counted: DataFrame, n_texts: int) -> dict:
    """The model from the corpus's (word, end, n)."""
    size = counted.agg(F.count_if(F.col("end").isNull()).alias("words"), F.count("end").alias("pairs")).first()
    widths, n_rows = table_bits(size["words"], size["pairs"]), size["words"] + size["pairs"]
    by_byte = counted.where("end is null").select("word", "n").mapInArrow(_count_bytes, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()  # 257 * 256 rows at most
    counts = np.zeros(257 * 256)
    for r in by_byte:
        counts[r["pair"]] = r["n"]
    counts = counts.reshape(257, 256)
    code = huffman(counts)
    tasks = max(6, -(-n_rows // WORDS_PER_TASK))
    tables = counted.repartition(tasks, "word").mapInArrow(_count_contexts(code, widths), TABLE_ROWS)
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        tables = tables.withColumn("source", F.floor(F.col("source") / FAN_IN)).repartition("k", "p", "source").sortWithinPartitions("k", "p", "source").mapInArrow(_add, TABLE_ROWS)
    model = {"code": code, "end": (n_texts + 0.5) / (counts[:, 32].sum() + 1.0), "widths": widths, "logits": [np.zeros(1 << w, np.int16) for w in widths], "sure": {k: np.zeros(1 << widths[k], np.uint8) for k in (WITHIN - 1, WITHIN)}}
    for r in tables.mapInArrow(_logits, "k long, p long, logits binary, sure binary").toLocalIterator():  # 2**MOST_BITS slots of a table at most
        for name, kind in (("logits", np.int16), ("sure", np.uint8)):
            if name == "logits" or r["k"] in model["sure"]:
                got = np.frombuffer(r[name], kind)
                model[name][r["k"]][r["p"] << PART_BITS : (r["p"] << PART_BITS) + len(got)] = got
    return model


# Scoring


def mixed_bits(own_rows: np.ndarray, at: np.ndarray, across: np.ndarray, counts: np.ndarray, weights: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Bits each text costs: at says which of own_rows each decision takes, across its logit across words and what its tag gains, STEP unused
    ones at the end; counts[i] decisions of text i. weights (text, gate's row, column; per unit) and met (text, bucket) go on from what they hold."""
    order = np.argsort(-counts, kind="stable")
    first, size = starts(counts)[:-1][order], counts[order]
    weights_, met_ = np.ascontiguousarray(weights[order]), met[order]
    at, across = np.lib.stride_tricks.sliding_window_view(at, STEP), np.lib.stride_tricks.sliding_window_view(across, STEP, 0)
    cost, reach, ones = np.zeros(len(order)), np.arange(STEP), np.ones(STEP // 4, np.float32)
    lane = np.arange(len(order))[:, None]
    place, lane_buckets = lane * (len(ROWS) * STEP) + reach, lane * BUCKETS
    half, learn_by, quarter = np.float32(BUCKETS // 2 + 0.5), np.float32(RATE * LOGIT_UNIT**2), STEP // 4
    begins = np.arange(0, size.max(initial=0), STEP)
    for begin, lanes in zip(begins.tolist(), np.searchsorted(-size, -begins).tolist()):  # lanes: those longer than begin
        window = first[:lanes] + begin
        here, further = own_rows.take(at[window], axis=0), across[window]
        planes = np.ascontiguousarray(here.transpose(0, 2, 1))
        planes[:, WITHIN] = further[:, 0]
        tag = planes[:, TAG] + further[:, 1]
        x = planes.astype(np.float32)
        y = (tag & 1).astype(np.float32)
        tag >>= 1
        chosen = CHOSEN.take(tag, axis=0)
        z = np.matmul(np.matmul(ROWS, weights_[:lanes]), x).ravel().take(place[:lanes] + tag * np.int16(STEP))  # by the sum of both gates' rows
        np.maximum(z, -14, out=z)
        np.minimum(z, 14, out=z)
        bucket = z * np.float32(1 / BUCKET_WIDTH)
        bucket += half
        np.maximum(bucket, 0, out=bucket)
        np.minimum(bucket, BUCKETS - 1, out=bucket)
        bucket = bucket.astype(np.intp)
        bucket += lane_buckets[:lanes]
        change = met_[:lanes].ravel().take(bucket)
        np.subtract(y, change, out=change)
        np.negative(z, out=z)
        np.exp(z, out=z)
        z += 1
        np.reciprocal(z, out=z)
        error = np.subtract(y, z, out=y)
        if size[lanes - 1] - begin < STEP:
            live = reach < (size[:lanes] - begin)[:, None]
            error *= live
            change *= live
        # The chance given to the bit that came is one less the mean error, by either stage.
        chance = np.multiply(error, 3, out=z)
        chance += change
        np.abs(chance, out=chance)
        np.subtract(4, chance, out=chance)  # four times the chance
        chance = chance[:, : 2 * quarter] * chance[:, 2 * quarter :]
        cost[:lanes] -= np.log2(chance[:, :quarter] * chance[:, quarter:]) @ ones - 2 * STEP
        error *= learn_by
        x *= error[:, None]
        gradient = np.matmul(chosen.transpose(0, 2, 1), x.transpose(0, 2, 1))
        gradient[..., TAG] = 0
        weights_[:lanes] += np.matmul(GATHER, gradient)
        learnt = np.bincount(bucket.ravel(), change.ravel(), minlength=lanes * BUCKETS)
        learnt *= MAP_RATE
        met_[:lanes] += learnt.reshape(lanes, BUCKETS)
        np.maximum(met_[:lanes], 1e-5, out=met_[:lanes])
        np.minimum(met_[:lanes], 1 - 1e-5, out=met_[:lanes])
    weights[order], met[order] = weights_, met_
    out = np.zeros(len(order))
    out[order] = cost
    return out


def word_rows(words: pa.Array, model: dict) -> tuple[np.ndarray, ...]:
    """Of distinct words: rows of their decisions with the logits within the word, how many each has, and of the decisions of heads the hashes and how many."""
    rows, keys, size, head_size = np.zeros((0, COLUMNS), np.int16), [], [], []
    used = 0
    for a in range(0, len(words), WORDS_AT_ONCE):
        slots, bit, key, head, edge = decisions(words.slice(a, WORDS_AT_ONCE), model["code"], model["widths"])
        if used + len(bit) > len(rows):  # grown in place by what the words so far took, with some room
            rows.resize((used + max(len(bit), int((used + len(bit)) / (a + WORDS_AT_ONCE) * (len(words) - a)) + 1000), COLUMNS), refcheck=False)
        part = rows[used : used + len(bit)]
        for k in range(WITHIN):
            part[:, k] = model["logits"][k].take(slots[k])
        part[:, CONSTANT] = round(1 / LOGIT_UNIT)
        part[:, TAG] = model["sure"][WITHIN - 1].take(slots[-1]).astype(np.int16) * (2 * GATES[1]) + bit
        used += len(bit)
        keys.append(key[head])
        size.append(np.diff(edge))
        head_size.append(np.add.reduceat(np.r_[head, False].astype(np.int64), edge[:-1]))
    return rows[:used], *(np.concatenate(v) for v in (size, keys, head_size))


def text_bits(texts: pa.Array, model: dict, at_once: int = DECISIONS_AT_ONCE) -> np.ndarray:
    """Bits of every text and its end; the texts' first chunks are coded, then the second ones and so on, about so many decisions at a time."""
    words, per_text = blank_words(texts)
    if not len(words):
        return np.zeros(len(texts))
    coded = words.dictionary_encode()
    index = np.asarray(coded.indices).astype(np.int64)
    own_rows, size, keys, head_size = word_rows(coded.dictionary, model)
    edge, head_edge = starts(size), starts(head_size)
    own_end = end_hashes(pc.binary_slice(coded.dictionary.cast(pa.large_binary()), -2, None))
    ends = before(own_end[index], per_text, end_hashes(pa.array([NO_WORD], pa.large_binary()))[0])
    word_edge, decided = starts(per_text), starts(size[index])
    order = np.argsort(-per_text, kind="stable")
    centre = (np.arange(BUCKETS) - BUCKETS // 2) * BUCKET_WIDTH
    sigmoid = (1 / (1 + np.exp(-centre))).astype(np.float32)
    longer = int((per_text > CHUNK_WORDS).sum())  # the first in order; these hand their state on
    begun = lambda n: (np.repeat(START[None] * np.float32(LOGIT_UNIT), n, 0), np.repeat(sigmoid[None], n, 0))
    kept_weights, kept_met = begun(longer)
    out = np.zeros(len(texts))
    for begin in range(0, int(per_text.max(initial=0)), CHUNK_WORDS):
        texts_ = order[: int((per_text > begin).sum())]
        n_words, first = np.minimum(per_text[texts_] - begin, CHUNK_WORDS), word_edge[texts_] + begin
        counts = decided[first + n_words] - decided[first]
        group = np.cumsum(counts) // at_once
        bounds = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts_)]
        for a, b in zip(bounds, bounds[1:]):
            of = ragged(first[a:b], n_words[a:b])
            own = index[of]
            n, heads = size[own], head_size[own]
            at = np.zeros(int(n.sum()) + STEP, np.int32)
            at[:-STEP] = ragged(edge[own], n, np.int32)
            place = ragged(starts(n)[:-1], heads)  # a word's first decisions are those of its head
            slot = across_slots(keys.take(ragged(head_edge[own], heads)), np.repeat(ends[of], heads), model["widths"])
            across = np.zeros((len(at), 2), np.int16)
            across[place, 0] = model["logits"][WITHIN].take(slot)
            across[place, 1] = model["sure"][WITHIN].take(slot).astype(np.int16) * 2
            carried = max(0, min(b, longer) - a)
            weights, met = begun(b - a)
            weights[:carried], met[:carried] = kept_weights[a : a + carried], kept_met[a : a + carried]
            out[texts_[a:b]] += mixed_bits(own_rows, at, across, counts[a:b], weights, met)
            kept_weights[a : a + carried], kept_met[a : a + carried] = weights[:carried], met[:carried]
    return out - np.log2(model["end"]) - (per_text - 1) * np.log2(1 - model["end"])


def _score(model, frequent):
    def score(batches):
        m, known = model.value, frequent.value
        values, counts = pa.array(known["tokens"], pa.large_string()), np.array(known["counts"], np.float64)
        row = TaskContext.get().partitionId() << 33
        for batch in pieces(batches, limit=SCORED_AT_ONCE):
            texts = batch.column(1)
            bits = text_bits(texts, m)
            words, per_text = split_words(texts, LOWER_BYTES)
            coded = words.dictionary_encode()
            at = pc.fill_null(pc.index_in(coded.dictionary, value_set=values), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            of_word = at[np.asarray(coded.indices)] if len(words) else np.zeros(0, np.int64)
            c = np.where(of_word >= 0, counts[of_word] if len(counts) else 0, 0)
            common = sum_by_row(np.where(of_word >= 0, np.log10(c + 1), 0.0), per_text)
            n_common = sum_by_row((of_word >= 0).astype(np.int64), per_text)
            doc = np.repeat(np.arange(batch.num_rows), per_text)
            rare = of_word < 0
            key, times = np.unique(doc[rare] * max(1, len(coded.dictionary)) + np.asarray(coded.indices)[rare], return_counts=True) if rare.any() else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            edge = pa.array(np.searchsorted(key // max(1, len(coded.dictionary)), np.arange(batch.num_rows + 1)).astype(np.int32))
            tokens = coded.dictionary.take(pa.array(key % max(1, len(coded.dictionary)))).cast(pa.string())
            uid = row + np.arange(batch.num_rows)
            row += batch.num_rows
            size = pc.binary_length(pc.fill_null(texts, "")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid), batch.column(0), size, pa.array(per_text.astype(np.int64)), pa.array(n_common), pa.array(common), pa.array(bits), pa.ListArray.from_arrays(edge, tokens), pa.ListArray.from_arrays(edge, pa.array(times.astype(np.int32)))],
                ["uid", "doc_id", "n_bytes", "n_words", "n_common", "common", "bits", "rare", "times"],
            )

    return score


def score_texts(documents: DataFrame, learn_from, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits, bits_per_byte of each row, learning from rows where the column learn_from holds."""
    spark, kind = documents.sparkSession, documents.schema[doc_id].dataType.simpleString()
    corpus = documents.where(learn_from).select(F.col(text).alias("text"))
    counted = cut(corpus.mapInArrow(_count_words, "word binary, end binary, n long").groupBy("word", "end").agg(F.sum("n").alias("n")))
    words = counted.where("end is null").select(F.col("word").cast("string").alias("word"), "n")
    n_texts = corpus.count()
    token = F.explode(F.filter(F.split(lower_ascii(F.col("word")), r"[\x20\x09-\x0D]+"), lambda t: t != ""))
    tokens = cut(words.select(token.alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n")))
    size = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, vocabulary = size["n"] + n_texts, size["v"] + (n_texts > 0)
    top = tokens.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    frequent = spark.sparkContext.broadcast({"tokens": top["token"].to_pylist(), "counts": top["n"].to_pylist()})
    model = spark.sparkContext.broadcast(learn(counted, n_texts))
    schema = f"uid long, doc_id {kind}, n_bytes long, n_words long, n_common long, common double, bits double, rare array<string>, times array<int>"
    rows = cut(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_score(model, frequent), schema))
    asked = rows.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("uid", F.col("r.rare").alias("token"), F.col("r.times").alias("times"))
    answered = asked.join(tokens, "token").groupBy("uid").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("found"), F.sum("times").alias("n_found"))
    out = rows.drop("rare", "times").join(answered, "uid", "left")
    per_token = F.log10(F.lit(float(total + vocabulary + 1)))
    n_tokens = F.col("n_words") + 1
    end = F.log10(F.lit(float(n_texts + 1)))
    return out.select(
        "doc_id", "n_bytes", n_tokens.alias("n_tokens"), (F.col("n_common") + F.coalesce("n_found", F.lit(0)) + F.lit(int(n_texts > 0))).cast("bigint").alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("common") + F.coalesce("found", F.lit(0.0)) + end - n_tokens * per_token).alias("base_score"), (-F.col("bits") * float(np.log10(2))).alias("score"), "bits", F.when(F.col("n_bytes") > 0, F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"),
    )


def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = lambda col: F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % 7 == 2
    scored = score_texts(table(spark, sf_dir, "documents"), ~held_out("doc_id"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
