"""Toxicity scores by a logistic model with a counterfactual penalty on identity terms.

Contract
* score is in 0 to 1, for null and empty texts too; predicted is 1 from 0.5 on. Only the text is scored.
* Labels are learnt from a bounded sample: the TRAIN_ROWS labelled rows of smallest key hash among those
  whose crc32(id as text) mod 5 is not 0. Rows of null label are left out; a label row that repeats an
  id counts by its larger label, of documents that repeat one the smallest text is learnt from; without two classes to learn, every score is the share of ones (0.5
  without any row). Rows that repeat an id are scored each; extra columns pass.

Features are words (A-Z lower-cased) and their beginnings of PREFIXES characters, by log of 1 + count,
picked by the chi-square of their document counts. Every sentence of the sample with identity terms has
counterfactual copies, a term swapped for each other one of its list; PENALTY times the squared change of
the sentence's logit, averaged over a term's copies, is added to the loss, so that naming one group or
another does not move the score. Lists are those given and, as texts may name no group of these, lists
found in the sample: frequent words that tell nothing of the label (their shares in both classes lie
within two standard errors), put together where they occur in the same texts. Tasks swap the terms in their
sentences and sum the products of the changes; the driver gets these sums, a number for two features.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, pieces, settle, split_words, starts, table

TRAIN_ROWS = 20_000
FEATURES = 1024
PREFIXES = (4, 5, 6, 7, 8)
L2, PENALTY = 1.0, 10.0
#: Frequent words looked at for further lists, the share of texts they occur in at least, how often two of a list meet, and a list's length.
FREQUENT_WORDS, LEAST_SHARE, TOGETHER, LIST_TERMS = 64, 0.05, 0.6, 6
#: Bytes of texts that a task works on at once; a longer text is taken whole.
TEXT_AT_ONCE = 2 << 20
#: What ends a sentence.
SENTENCE_END = r"[.!?\n。！？]+"
#: Newton steps at most, and training rows laid out at once.
STEPS, BLOCK = 12, 1000
#: Terms of a list stand for each other in counterfactual copies; a parameter of fit().
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("black", "white", "asian", "latino"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "foreigners", "natives"), ("disabled", "deaf", "blind"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("frauen", "männer"), ("muslime", "christen", "juden"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


def held_out(col, parts: int, rest: int):
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % parts == rest


def word_features(words: pa.Array):
    """(prefix length or 0, feature strings, mask of words long enough) for each kind of feature."""
    yield 0, words, None
    size = pc.utf8_length(words)
    for k in PREFIXES:
        yield k, pc.binary_join_element_wise(pa.scalar("^", words.type), pc.utf8_slice_codeunits(words, 0, k), pa.scalar("", words.type)), np.asarray(pc.greater_equal(size, k))


def word_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, and (document, word, times) of each text's own."""
    words, per_doc = split_words(texts)
    coded = words.dictionary_encode()
    many = max(1, len(coded.dictionary))
    key, n = np.unique(np.repeat(np.arange(len(texts)), per_doc) * many + np.asarray(coded.indices), return_counts=True)
    return coded.dictionary, key // many, key % many, n


def _document_counts():
    def count(batches):
        for batch in pieces(batches, limit=TEXT_AT_ONCE):
            y = np.asarray(batch.column(1)).astype(np.int64)
            known, doc, word, _ = word_counts(batch.column(0))
            for _, names, mask in word_features(known):
                own = names.dictionary_encode()
                many = max(1, len(own.dictionary))
                keep = np.ones(len(word), bool) if mask is None else mask[word]
                pair = np.unique(doc[keep] * many + np.asarray(own.indices)[word[keep]]) if len(word) else np.zeros(0, np.int64)
                of = pair % many
                n = [np.bincount(of[y[pair // many] == k], minlength=len(own.dictionary)) for k in (0, 1)]
                some = (n[0] + n[1]) > 0
                yield pa.RecordBatch.from_arrays([own.dictionary.filter(pa.array(some)).cast(pa.string()), pa.array(n[0][some]), pa.array(n[1][some])], ["feature", "n0", "n1"])
        settle()

    return count


def feature_rows(texts: pa.Array, names: list[str]):
    """(document, feature, log of 1 + count) of the chosen features."""
    known, doc, word, n = word_counts(texts)
    chosen, keys, times = pa.array(names, pa.large_string()), [], []
    for _, feats, mask in word_features(known):
        at = pc.fill_null(pc.index_in(feats, value_set=chosen), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if mask is not None:
            at = np.where(mask, at, -1)
        f = at[word] if len(word) else np.zeros(0, np.int64)
        keys.append(doc[f >= 0] * len(names) + f[f >= 0])
        times.append(n[f >= 0])
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key // max(1, len(names)), key % max(1, len(names)), np.log1p(np.bincount(place, np.concatenate(times), minlength=len(key)))


def _training_features(names: list[str]):
    def features(batches):
        for batch in pieces(batches, limit=TEXT_AT_ONCE):
            doc, f, x = feature_rows(batch.column(0), names)
            edge = pa.array(starts(np.bincount(doc, minlength=batch.num_rows)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.ListArray.from_arrays(edge, pa.array(f.astype(np.int32))), pa.ListArray.from_arrays(edge, pa.array(x.astype(np.float32)))], ["y", "f", "x"])

    return features


def _met_together(terms: list[str]):
    """(a, b, n): texts that hold both terms, by place in the list."""

    def count(batches):
        total = np.zeros((len(terms), len(terms)), np.int64)
        for batch in pieces(batches, limit=TEXT_AT_ONCE):
            words, per_doc = split_words(batch.column(0))
            at = pc.fill_null(pc.index_in(words, value_set=pa.array(terms, pa.large_string())), -1).to_numpy(zero_copy_only=False)
            there = np.zeros((batch.num_rows, len(terms)), np.int64)
            there[np.repeat(np.arange(batch.num_rows), per_doc)[at >= 0], at[at >= 0]] = 1
            total += there.T @ there
        a, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total[a, b])], ["a", "b", "n"])

    return count


def further_lists(sample: DataFrame, frequent: list, n0: int, n1: int) -> list[tuple[str, ...]]:
    """Lists of frequent words (feature, n0, n1) that tell nothing of the label and occur in the same texts."""
    neutral = []
    for r in frequent:
        p, q, both = r["n0"] / n0, r["n1"] / n1, (r["n0"] + r["n1"]) / (n0 + n1)
        if abs(p - q) <= 2 * (both * (1 - both) * (1 / n0 + 1 / n1)) ** 0.5:
            neutral.append(r["feature"])
    if len(neutral) < 2:
        return []
    met = np.zeros((len(neutral), len(neutral)))
    for r in sample.mapInArrow(_met_together(neutral), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():  # FREQUENT_WORDS squared at most
        met[r["a"], r["b"]] = r["n"]
    alone = np.diag(met)
    alike = met / np.sqrt(np.outer(alone, alone))
    lists, free = [], list(range(len(neutral)))
    while free:
        mates = [i for i in free if alike[free[0], i] >= TOGETHER][:LIST_TERMS]
        free = [i for i in free if i not in mates]
        if len(mates) > 1:
            lists.append(tuple(neutral[i] for i in mates))
    return lists


def _swap_changes(lists, names: list[str]):
    """(i, j, move, sentences): summed products of what swaps change in features i and j; sentences that hold any term in the first row.

    A swap puts another term of a list in the place of every mention of one. Its change of a feature is that of
    log of 1 + count over the whole sentence, so words that share a beginning with a term count as well. Of a
    term's swaps in a sentence each weighs one over their number.
    """
    terms = [t for ts in lists for t in ts]
    own = term_features(terms, names)
    touched = sorted({f for fs in own for f in fs})
    column = {f: i for i, f in enumerate(touched)}
    own = [[column[f] for f in fs] for fs in own]
    chosen = [names[f] for f in touched]
    mates = [(at, base + k, len(ts) - 1) for at, ts, base in _places(lists) for k in range(len(ts)) if base + k != at]

    def count(batches):
        total, met = np.zeros((len(touched), len(touched))), 0
        for batch in pieces(batches, limit=TEXT_AT_ONCE):
            parts = pc.split_pattern_regex(pc.fill_null(batch.column(0), "").cast(pa.large_string()), SENTENCE_END).flatten()
            words, per_sentence = split_words(parts)
            at = pc.fill_null(pc.index_in(words, value_set=pa.array(terms, pa.large_string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            sentence = np.repeat(np.arange(len(per_sentence)), per_sentence)[at >= 0]
            held, sentence = np.unique(sentence, return_inverse=True)
            met += len(held)
            for first in range(0, len(held), 4096):
                here = held[first : first + 4096]
                part = (sentence >= first) & (sentence < first + 4096)
                m = np.zeros((len(here), len(terms)))
                np.add.at(m, (sentence[part] - first, at[at >= 0][part]), 1)
                c = np.zeros((len(here), len(touched)))
                doc, f, x = feature_rows(parts.take(pa.array(here)), chosen)
                c[doc, f] = np.rint(np.expm1(x))
                for a, b, others in mates:
                    some = np.flatnonzero(m[:, a])
                    both = sorted({*own[a], *own[b]})
                    if len(some) and both:
                        move = np.isin(both, own[b]).astype(float) - np.isin(both, own[a])
                        before = c[np.ix_(some, both)]
                        change = np.log1p(before + m[some, a][:, None] * move) - np.log1p(before)
                        total[np.ix_(both, both)] += change.T @ change / others
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, np.array(touched, np.int64)[i]]), pa.array(np.r_[-1, np.array(touched, np.int64)[j]]), pa.array(np.r_[0.0, total[i, j]]), pa.array(np.r_[met, np.zeros(len(i), np.int64)])], ["i", "j", "move", "sentences"])

    return count


def term_features(terms: list[str], names: list[str]) -> list[list[int]]:
    """The chosen features that each term has: itself and its beginnings."""
    own, index = [[] for _ in terms], {name: i for i, name in enumerate(names)}
    for _, feats, mask in word_features(pa.array(terms, pa.large_string())):
        for i, f in enumerate(feats.to_pylist()):
            if f in index and (mask is None or mask[i]):
                own[i].append(index[f])
    return own


def _places(lists):
    """(place of a term among all, its list, place of the list's first)."""
    base = 0
    for names in lists:
        for i in range(len(names)):
            yield base + i, names, base
        base += len(names)


def _penalty(sample: DataFrame, lists, names: list[str]) -> tuple[np.ndarray, int]:
    """Sum of the outer products of the swaps' changes of features, and the number of sentences with swaps."""
    out, sentences = np.zeros((len(names), len(names))), 0
    if not lists:
        return out, sentences
    moves = sample.mapInArrow(_swap_changes(lists, names), "i long, j long, move double, sentences long").groupBy("i", "j").agg(F.sum("move").alias("move"), F.sum("sentences").alias("sentences"))
    for r in moves.collect():  # a row for two features of the lists' terms at most
        sentences += r["sentences"]
        if r["i"] >= 0:
            out[r["i"], r["j"]] += r["move"]
    return out, sentences


def train_sample(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, y) of the bounded sample: a row an id, the smallest text where rows repeat one."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("y")).where(~held_out("_id", 5, 0))
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).groupBy("_id", "y").agg(F.min("text").alias("text")).select("text", "y")


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, features: int = FEATURES, identity=IDENTITY_TERMS, penalty: float = PENALTY, derive: bool = True) -> dict:
    """The model: feature names, their weights, a bias, the lists of terms, and the number of sentences with swaps."""
    sample = cut(train_sample(documents, labels, rows))
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.5
        return {"names": [], "w": np.zeros(0), "bias": float(np.log((share + 1e-6) / (1 - share + 1e-6))), "lists": [], "swapped": 0}
    counts = cut(sample.mapInArrow(_document_counts(), "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n0 + n1 >= 3"))
    chi = F.pow(F.col("n1") / n1 - F.col("n0") / n0, 2) / (F.col("n0") + F.col("n1") + 3)
    # The features of smallest support come last whatever their chi-square; terms of the lists are always in.
    best = [r["feature"] for r in counts.orderBy(F.desc(chi), "feature").limit(features).select("feature").collect()]
    given = {t for terms in identity for t in terms}
    found = {r["feature"] for r in counts.where(F.col("feature").isin(sorted(given))).select("feature").collect()} if given else set()
    lists = [terms for terms in map(tuple, identity) if found & set(terms)]
    if derive:
        frequent = counts.where((F.col("n0") + F.col("n1") >= LEAST_SHARE * (n0 + n1)) & ~F.col("feature").startswith("^")).orderBy(F.desc(F.col("n0") + F.col("n1")), "feature").limit(FREQUENT_WORDS).collect()
        lists += further_lists(sample, [r for r in frequent if r["feature"] not in given], n0, n1)
    names = list(dict.fromkeys(best + sorted({t for terms in lists for t in terms})))
    data = sample.mapInArrow(_training_features(names), "y int, f array<int>, x array<float>").toArrow()  # TRAIN_ROWS rows at most
    moves, swapped = _penalty(sample, lists, names)
    return _optimise(data, names, penalty * moves) | {"lists": lists, "swapped": swapped}


def _optimise(data: pa.Table, names: list[str], moves: np.ndarray) -> dict:
    """Newton steps on the logistic loss with the ridge and the swaps' quadratic penalty."""
    y, rows = data["y"].to_numpy().astype(np.float64), data.num_rows
    edge = starts(pc.list_value_length(data["f"]).to_numpy())
    f, x = pc.list_flatten(data["f"]).to_numpy(), pc.list_flatten(data["x"]).to_numpy()
    # Columns: the features and one.
    width = len(names) + 1

    def block(a: int, b: int) -> np.ndarray:
        out, part = np.zeros((b - a, width)), slice(edge[a], edge[b])
        out[np.repeat(np.arange(b - a), np.diff(edge[a : b + 1])), f[part]] = x[part]
        out[:, -1] = 1
        return out

    fixed = np.diag(np.r_[np.full(width - 1, L2), 1e-6])
    fixed[:-1, :-1] += 2 * moves
    beta = np.zeros(width)
    beta[-1] = np.log(y.mean() / (1 - y.mean()))
    for _ in range(STEPS):
        hessian, gradient = fixed.copy(), fixed @ beta
        for a in range(0, rows, BLOCK):
            part = block(a, min(rows, a + BLOCK))
            p = 1 / (1 + np.exp(-np.clip(part @ beta, -30, 30)))
            hessian += part.T @ (part * (p * (1 - p))[:, None])
            gradient += part.T @ (p - y[a : a + BLOCK])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        beta -= step
        if np.abs(step).max() < 1e-4:
            break
    return {"names": names, "w": beta[:-1], "bias": float(beta[-1])}


def score_texts(texts: pa.Array, model: dict) -> np.ndarray:
    doc, f, x = feature_rows(texts, model["names"])
    z = np.bincount(doc, model["w"][f] * x, minlength=len(texts)) if len(doc) else np.zeros(len(texts))
    return 1 / (1 + np.exp(-np.clip(z + model["bias"], -700, 700)))


def scorer(model: dict):
    """The model as an Arrow UDF of a text column."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [score_texts(part.column(0), model) for part in pieces([pa.RecordBatch.from_arrays([texts], ["text"])], limit=TEXT_AT_ONCE)]
        settle()
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"))
    scored = documents.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), scorer(model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("swapped_sentences", F.lit(model["swapped"]).cast("bigint"))


def drop_toxic(documents: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """documents without those that the model, learnt from labelled and labels, scores 0.5 or more; all of them, where labels don't show both classes."""
    model = fit(labelled, labels)
    return documents.where(scorer(model)(F.col("text")) < 0.5) if model["names"] else documents
