"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte of a text is a position.  A text is cut into windows of ``WINDOW`` bytes; in each,
one gated recurrent layer reads forwards and one backwards, and a softmax over both states
labels every position.  Where such layers commonly have tanh, these have x / (1 + |x|), which
costs a fifth of it in numpy.  A document's probabilities are the mean over all of its positions, so
whole texts count, whatever their length, and windows are the same work on any machine.

The network is trained in numpy by backpropagation through time on a bounded sample:
``PER_LANGUAGE`` documents of each language, the first by a hash of their key, and of each one
passage of ``PASSAGE`` bytes at a place given by the hash.  Predictions read texts only.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0, as is every text
if no row teaches a language; a NULL language teaches nothing; rows without a key count as
having an empty one; an empty table gives no rows; columns that clash are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.rows import by_bytes
from pagetables.llm.common import Tucked

HIDDEN = 8
WINDOW = 128
GROUPS = 1024  # of tasks, when the least hashes of a language are looked for
PER_LANGUAGE = 400
PASSAGE = 512
TRAIN_WINDOW = 64
TRAIN_BATCH = 192
STEPS = 240
UNKNOWN = "und"
OVER_CHANCE = 0.1  # what a score must have over that of a guess among n languages, as a part of it
MOST_UNKNOWN = 0.2  # of the bytes of letters, those that no teaching passage has
NO_LETTER = bytes(c for c in range(128) if not chr(c).isalpha())
BATCH_BYTES = 2 * 1024 * 1024
BATCH_WINDOWS = 2048


@dataclass
class Direction:
    """One gated layer: input table (3 H, 256), recurrent weights (3 H, H), bias of the
    candidate's recurrent part (H).  Gates are rows 0 to 2 H (reset, update) and the rest."""

    table: np.ndarray
    recur: np.ndarray
    bias: np.ndarray


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    out: np.ndarray  # (languages, 2 H)
    shift: np.ndarray  # (languages, 1)
    known: bytes = b""  # the bytes of the teaching passages


def _bend(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * _bend(x) + 0.5


def initial(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def part(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    def direction() -> Direction:
        return Direction(part(3 * hidden, 256, scale=0.3), part(3 * hidden, hidden, scale=0.3), np.zeros((hidden, 1), np.float32))

    return Network(languages, direction(), direction(), part(len(languages), 2 * hidden, scale=0.3), np.zeros((len(languages), 1), np.float32))


def _read(d: Direction, letters: np.ndarray, mask: np.ndarray, order: range) -> tuple[np.ndarray, list]:
    """States (T, H, B) of one direction over letters (T, B), and what training needs."""
    hidden = d.recur.shape[1]
    state = np.zeros((hidden, letters.shape[1]), dtype=np.float32)
    states = np.zeros((len(letters), hidden, letters.shape[1]), dtype=np.float32)
    kept = []
    for t in order:
        x = d.table[:, letters[t]]
        u = d.recur @ state
        gates = _gate(x[: 2 * hidden] + u[: 2 * hidden])
        reset, update = gates[:hidden], gates[hidden:]
        inner = u[2 * hidden :] + d.bias
        new = _bend(x[2 * hidden :] + reset * inner)
        after = ((1 - update) * new + update * state) * mask[t]
        kept.append((t, state, reset, update, inner, new))
        state = states[t] = after
    return states, kept


def _learn(d: Direction, letters: np.ndarray, mask: np.ndarray, kept: list, wanted: np.ndarray) -> Direction:
    """Gradients of one direction from those of its states, backwards through time."""
    hidden = d.recur.shape[1]
    table, recur, bias = np.zeros_like(d.table), np.zeros_like(d.recur), np.zeros_like(d.bias)
    carried = np.zeros_like(wanted[0])
    for t, state, reset, update, inner, new in reversed(kept):
        grad = (wanted[t] + carried) * mask[t]
        g_new = grad * (1 - update) * (1 - np.abs(new)) ** 2
        g_update = grad * (state - new) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
        g_reset = g_new * inner * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
        g_inner = g_new * reset
        to_recur = np.concatenate([g_reset, g_update, g_inner])
        recur += to_recur @ state.T
        bias += g_inner.sum(axis=1, keepdims=True)
        to_input = np.concatenate([g_reset, g_update, g_new])
        one_hot = np.zeros((letters.shape[1], 256), dtype=np.float32)
        one_hot[np.arange(letters.shape[1]), letters[t]] = 1
        table += to_input @ one_hot
        carried = grad * update + d.recur.T @ to_recur
    return Direction(table, recur, bias)


def gradients(net: Network, letters: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of all positions, and its gradient for every weight."""
    steps = range(len(letters))
    ahead, kept_ahead = _read(net.ahead, letters, mask, steps)
    back, kept_back = _read(net.back, letters, mask, steps[::-1])
    both = np.concatenate([ahead, back], axis=1)  # (T, 2 H, B)
    logits = net.out @ both + net.shift
    logits -= logits.max(axis=1, keepdims=True)
    chance = np.exp(logits)
    chance /= chance.sum(axis=1, keepdims=True)
    total = mask.sum()
    picked = np.take_along_axis(chance, labels[None, None, :].repeat(len(letters), 0), axis=1)[:, 0]
    loss = float(-(np.log(picked + 1e-9) * mask).sum() / total)
    wrong = chance
    wrong[:, labels, np.arange(len(labels))] -= 1
    wrong *= (mask / total)[:, None, :]
    out = np.einsum("tcb,thb->ch", wrong, both)
    to_states = np.einsum("ch,tcb->thb", net.out, wrong)
    hidden = net.ahead.recur.shape[1]
    a = _learn(net.ahead, letters, mask, kept_ahead, to_states[:, :hidden])
    b = _learn(net.back, letters, mask, kept_back, to_states[:, hidden:])
    return loss, [a.table, a.recur, a.bias, b.table, b.recur, b.bias, out, wrong.sum(axis=(0, 2))[:, None]]


def _weights(net: Network) -> list[np.ndarray]:
    return [net.ahead.table, net.ahead.recur, net.ahead.bias, net.back.table, net.back.recur, net.back.bias, net.out, net.shift]


def train(samples: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = TRAIN_BATCH,
          window: int = TRAIN_WINDOW, rate: float = 0.02, seed: int = 11) -> Network:
    """A network from ``(language, passage)`` pairs, the same for the same pairs."""
    samples = [(lang, p) for lang, p in samples if p]
    languages = sorted({lang for lang, _ in samples})
    net = initial(languages, hidden)
    net.known = bytes(sorted(set().union(*(p for _, p in samples))))
    if len(languages) < 2:
        return net
    by_language = [[np.frombuffer(p, dtype=np.uint8) for lang, p in samples if lang == name] for name in languages]
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in _weights(net)]
    second = [np.zeros_like(w) for w in _weights(net)]
    for step in range(1, steps + 1):
        letters, mask = np.zeros((window, batch), dtype=np.uint8), np.zeros((window, batch), dtype=np.float32)
        labels = np.arange(batch) % len(languages)
        for b, label in enumerate(labels):
            passage = by_language[label][rng.integers(len(by_language[label]))]
            # A third of the windows are short, as short texts are.
            most = window if rng.random() < 0.67 else int(rng.integers(4, window))
            at = int(rng.integers(max(1, len(passage) - most + 1)))
            part = passage[at : at + most]
            letters[: len(part), b], mask[: len(part), b] = part, 1
        _, grads = gradients(net, letters, mask, labels)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(_weights(net), grads, first, second):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def _step(d: Direction, letters: np.ndarray, state: np.ndarray, x: np.ndarray, u: np.ndarray) -> None:
    """One position of all windows, in place."""
    hidden = len(state)
    np.take(d.table, letters, axis=1, out=x, mode="clip")
    np.matmul(d.recur, state, out=u)
    gates, inner, spare = u[: 2 * hidden], u[2 * hidden :], x[: 2 * hidden]
    gates += spare
    np.abs(gates, out=spare)
    spare += 1
    gates /= spare
    gates *= 0.5
    gates += 0.5
    inner += d.bias
    inner *= gates[:hidden]
    inner += x[2 * hidden :]
    spare = spare[:hidden]
    np.abs(inner, out=spare)
    spare += 1
    inner /= spare
    state -= inner
    state *= gates[hidden:]
    state += inner


def position_sums(net: Network, letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums (languages, B) of the label probabilities of all positions of windows (T, B)."""
    steps, width = letters.shape
    hidden = net.ahead.recur.shape[1]
    x, u = np.empty((3 * hidden, width), np.float32), np.empty((3 * hidden, width), np.float32)
    mask = (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32)
    states = np.empty((steps, hidden, width), np.float32)
    state = np.zeros((hidden, width), np.float32)
    for t in range(steps):
        _step(net.ahead, letters[t], state, x, u)
        states[t] = state
    left, right = np.ascontiguousarray(net.out[:, :hidden]), np.ascontiguousarray(net.out[:, hidden:])
    sums = np.zeros((len(net.languages), width), np.float32)
    state[:] = 0
    for t in range(steps - 1, -1, -1):
        _step(net.back, letters[t], state, x, u)
        state *= mask[t]
        chance = left @ states[t]
        chance += right @ state
        chance += net.shift
        np.exp(chance, out=chance)
        chance *= mask[t] / chance.sum(axis=0)
        sums += chance
    return sums


def document_chances(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean label probabilities (texts, languages) over all positions of each text."""
    sums = np.zeros((len(texts), len(net.languages)))
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // WINDOW)
    owners = np.repeat(np.arange(len(texts)), counts)
    data = np.frombuffer(b"".join(texts) + bytes(WINDOW), dtype=np.uint8)
    starts = np.r_[0, np.cumsum(sizes)[:-1]] if len(texts) else sizes
    nth = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = starts[owners] + nth * WINDOW
    lengths = np.minimum(WINDOW, sizes[owners] - nth * WINDOW)
    by_length = np.argsort(-lengths, kind="stable")
    for at in range(0, len(by_length), BATCH_WINDOWS):
        some = by_length[at : at + BATCH_WINDOWS]
        longest = int(lengths[some].max())
        letters = data[begins[some][None, :] + np.arange(longest)[:, None]].astype(np.intp)
        found = position_sums(net, letters, lengths[some])
        np.add.at(sums, owners[some], found.T)
    return sums / np.maximum(sizes, 1)[:, None]


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def teaching_sample(docs: DataFrame, text: str, lang: str, key: str, per_language: int = PER_LANGUAGE) -> list:
    """``(language, passage)`` of at most ``per_language`` documents of each language, the first
    by hash.

    NULL and empty texts teach nothing and take no other's place.  The languages' cutoffs are
    found on hashes alone, in two levels: tasks in groups, then what is left of the groups, at
    most ``GROUPS * per_language`` hashes of a language however large its share.  Texts are then
    read where they are, and only the passages come here.
    """
    taught = docs.filter(F.col(lang).isNotNull() & ~held_out(F.col(key)) & (F.col(text) != ""))
    hashed = F.xxhash64(F.col(key).cast("string"), F.lit("teach"))
    least = taught.select(
        F.col(lang).alias("lang"), hashed.alias("hash"), (F.spark_partition_id() % GROUPS).alias("tasks")
    )
    for keys in (["lang", "tasks"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("hash")
        least = least.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_language).drop("n")
    cutoffs = least.groupBy("lang").agg(F.max("hash").alias("hash")).collect()
    if not cutoffs:
        return []
    last = F.create_map(*[F.lit(x) for r in cutoffs for x in (r["lang"], r["hash"])])
    some = taught.filter(hashed <= F.try_element_at(last, F.col(lang)))
    span = F.greatest(F.lit(1), F.length(text) - F.lit(PASSAGE))
    at = F.pmod(F.shiftright(hashed, 30), span).cast("int") + 1
    passages = some.select(F.col(lang).alias("lang"), hashed.alias("hash"), F.substring(text, at, F.lit(PASSAGE)).alias("passage"))
    # Rows that share a key share its place: one of them teaches.
    rows = passages.groupBy("lang", "hash").agg(F.min("passage").alias("passage")).collect()
    return sorted((r["lang"], r["passage"].encode()[:PASSAGE]) for r in rows)


def unknown_share(net: Network, text: bytes) -> float:
    """The part of a text's letters, in bytes, that no teaching passage has."""
    letters = text.translate(None, NO_LETTER)
    return len(letters.translate(None, net.known)) / max(1, len(letters))


def predict(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """All rows with ``lang_pred`` and ``score``.  Narrow."""
    tucked = Tucked(docs)
    return _labelled(tucked, net, text).select(*tucked.back("lang_pred", "score"), "lang_pred", "score")


def _labelled(tucked: Tucked, net: Network, text: str) -> DataFrame:
    at = tucked.names.index(text)
    schema = tucked.frame.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "unknown": F.lit(0.0)}).schema

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at, BATCH_BYTES):
            texts = batch.column(at).fill_null("").to_pylist()
            letters = [net.languages and any(map(str.isalpha, t)) for t in texts]
            coded = [t.encode() if ok else b"" for t, ok in zip(texts, letters)]
            chances = document_chances(net, coded)
            unknown = [unknown_share(net, t) for t in coded]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for i, ok in enumerate(letters):
                if ok:
                    best = int(chances[i].argmax())
                    names[i], scores[i] = net.languages[best], min(1.0, round(float(chances[i][best]), 6))
            added = [pa.array(names), pa.array(scores, pa.float64()), pa.array(unknown, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return tucked.frame.mapInArrow(label, schema)


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", **sizes) -> DataFrame:
    """All rows with ``lang_pred`` and ``score``, from a network trained on a sample of them."""
    return predict(docs, train(teaching_sample(docs, text, lang, key, **sizes)), text)


def recognised(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
               over_chance: float = OVER_CHANCE, most_unknown: float = MOST_UNKNOWN) -> DataFrame:
    """The rows in a known language, with the columns of the input; the others are rejected.

    Rejected are texts without a letter; those of whose letters' bytes more than
    ``most_unknown`` are in no teaching passage, which are in a script that wasn't learned
    (networks are often sure about such texts, so their score says nothing); and those whose
    score among n languages is not over (1 + ``over_chance``) / n, little more than a guess
    has.  One language alone has no such limit.
    """
    tucked = Tucked(docs)
    net = train(teaching_sample(docs, text, lang, key))
    least = (1 + over_chance) / len(net.languages) if len(net.languages) > 1 else 0.0
    clear = (F.col("lang_pred") != UNKNOWN) & (F.col("unknown") <= most_unknown) & (F.col("score") > least)
    return _labelled(tucked, net, text).filter(clear).select(*tucked.back())
