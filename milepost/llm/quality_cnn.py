"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned vector; learned filters of ``WIDTH`` bytes run over chunks of
``CHUNK`` bytes that overlap by ``CHUNK - STEP`` and cover the whole text. Each filter is
max-pooled per chunk; the mean and the maximum over all chunks enter one logistic unit.
Long texts are worked on in blocks of chunks, so memory does not grow with a text.

The network is fitted on the driver on a bounded sample of labelled rows (``TRAIN_ROWS``
rows and ``TRAIN_BYTES`` bytes at most, in the order of a hash of the key); every row of the
input is scored. Null and empty texts have one chunk of padding and so the same score;
repeated rows score alike; without any usable label all scores are 0.5. An empty table gives
an empty result. Only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import pieces, text_bytes

DIMENSIONS, FILTERS, WIDTH, STRIDE = 8, 32, 8, 4
CHUNK, STEP = 512, 448
WINDOWS, STEP_WINDOWS = (CHUNK - WIDTH) // STRIDE + 1, STEP // STRIDE
BLOCK_CHUNKS = 512
PAD = 256
TRAIN_ROWS, TRAIN_BYTES = 2_000, 24_000_000
EPOCHS, BATCH_DOCS, RATE, DECAY = 8, 32, 4e-3, 1e-4
PART_BYTES = 1_000_000


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def start_weights(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(size=shape).astype(np.float32)
    table = 0.5 * normal(PAD + 1, DIMENSIONS)
    table[PAD] = 0
    return {
        "table": table,
        "filters": normal(WIDTH * DIMENSIONS, FILTERS) / np.sqrt(WIDTH * DIMENSIONS).astype(np.float32) * 2,
        "bias": np.zeros(FILTERS, np.float32),
        "out": 0.1 * normal(2 * FILTERS),
        "shift": np.zeros(1, np.float32),
    }


def convolved(net: dict[str, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Filter values at every window of a run of codes whose length is a multiple of the stride."""
    half = STRIDE * DIMENSIONS
    rows = net["table"][codes].reshape(-1, half)
    values = rows[:-1] @ net["filters"][:half]
    values += rows[1:] @ net["filters"][half:]
    return values


def _blocks(at: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first byte, last byte) of all blocks of a batch of texts."""
    out = []
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        n_chunks = max(1, -(-(b - a - CHUNK) // STEP) + 1)
        for c in range(0, n_chunks, BLOCK_CHUNKS):
            first = a + c * STEP
            out.append((k, first, min(b, first + (BLOCK_CHUNKS - 1) * STEP + CHUNK)))
    return out


def scores(net: dict[str, np.ndarray], flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Probability of each text, given as bounds in the bytes of all."""
    n = len(at) - 1
    total, top, count = np.zeros((n, FILTERS), np.float32), np.full((n, FILTERS), -np.inf, np.float32), np.zeros(n)
    todo = _blocks(at)
    while todo:
        size, some = 0, []
        while todo and (not some or size + todo[-1][2] - todo[-1][1] < PART_BYTES):
            some.append(todo.pop())
            size += some[-1][2] - some[-1][1]
        codes, bounds, owner, begun = [], [], [], 0
        for k, a, b in some:
            windows = max(1, -(-(b - a - WIDTH) // STRIDE) + 1)
            padded = np.full((windows - 1) * STRIDE + WIDTH, PAD, np.int16)
            padded[: b - a] = flat[a:b]
            codes.append(padded)
            for c in range(0, max(1, windows - WINDOWS + STEP_WINDOWS), STEP_WINDOWS):
                bounds += (begun + c, begun + min(windows, c + WINDOWS))
                owner.append(k)
            begun += len(padded) // STRIDE
        values = convolved(net, np.concatenate([*codes, np.full(STRIDE, PAD, np.int16)]))
        best = np.maximum(np.maximum.reduceat(values, np.array(bounds), axis=0)[::2] + net["bias"], 0)
        np.add.at(total, owner, best)
        np.maximum.at(top, owner, best)
        np.add.at(count, owner, 1)
    logit = (total / count[:, None]) @ net["out"][:FILTERS] + top @ net["out"][FILTERS:] + net["shift"][0]
    return 1 / (1 + np.exp(-logit.astype(np.float64)))


def _chunks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's chunks and the number of windows in each."""
    n = max(1, -(-(len(text) - CHUNK) // STEP) + 1)
    codes = np.full((n, CHUNK), PAD, np.int16)
    windows = np.empty(n, np.int64)
    raw = np.frombuffer(text, np.uint8)
    for c in range(n):
        own = raw[c * STEP : c * STEP + CHUNK]
        codes[c, : len(own)] = own
        windows[c] = max(1, -(-(len(own) - WIDTH) // STRIDE) + 1)
    return codes, windows


def _gradients(net, codes, windows, owner, n, labels):
    """Loss gradients of one batch of texts."""
    chunks = np.arange(len(codes))[:, None]
    values = convolved(net, np.append(codes.ravel(), np.full(STRIDE, PAD, np.int16)))
    values = values.reshape(len(codes), CHUNK // STRIDE, FILTERS)[:, :WINDOWS]
    values = np.where((np.arange(WINDOWS) < windows[:, None])[:, :, None], values, -np.inf)
    where = values.argmax(1)
    best = np.maximum(np.take_along_axis(values, where[:, None], 1)[:, 0] + net["bias"], 0)
    count = np.bincount(owner, minlength=n)[:, None].astype(np.float32)
    total, top = np.zeros((n, FILTERS), best.dtype), np.zeros((n, FILTERS), best.dtype)
    np.add.at(total, owner, best)
    np.maximum.at(top, owner, best)
    mean = total / count
    logit = mean @ net["out"][:FILTERS] + top @ net["out"][FILTERS:] + net["shift"][0]
    error = ((1 / (1 + np.exp(-logit)) - labels) / n).astype(np.float32)
    grads = {"out": np.concatenate([mean.T @ error, top.T @ error]), "shift": error.sum(keepdims=True)}
    back = (error / count[:, 0])[owner, None] * net["out"][:FILTERS]
    back = back + np.where(best == top[owner], error[owner, None] * net["out"][FILTERS:], 0)
    back = np.where(best > 0, back, 0)
    spots = where[:, :, None] * STRIDE + np.arange(WIDTH)
    seen = codes[chunks[:, :, None], spots]
    inputs = net["table"][seen].reshape(len(codes), FILTERS, -1)
    grads["filters"] = np.einsum("ck,ckd->dk", back, inputs)
    grads["bias"] = back.sum(0)
    spread = (back[:, :, None] * net["filters"].T[None]).reshape(-1, DIMENSIONS)
    grads["table"] = np.zeros_like(net["table"])
    np.add.at(grads["table"], seen.ravel(), spread)
    grads["table"][PAD] = 0
    return grads


def fit(texts: list[bytes], labels: list[int], seed: int = 0) -> dict[str, np.ndarray] | None:
    """Network fitted by Adam; None unless both labels occur."""
    if len(set(labels)) < 2:
        return None
    rng, net = np.random.default_rng(seed), start_weights(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    data = [_chunks(x) for x in texts]
    labels = np.array(labels, np.float32)
    batches = max(1, -(-len(data) // BATCH_DOCS))
    rounds, step = max(EPOCHS, -(-200 // batches)), 0  # small samples still get some hundred steps
    for epoch in range(rounds):
        for some in np.array_split(rng.permutation(len(data)), batches):
            step += 1
            rate = RATE * (1 - epoch / rounds)
            owner = np.repeat(np.arange(len(some)), [len(data[i][0]) for i in some])
            codes = np.concatenate([data[i][0] for i in some])
            windows = np.concatenate([data[i][1] for i in some])
            for k, g in _gradients(net, codes, windows, owner, len(some), labels[some]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                net[k] -= rate * (move + DECAY * net[k]).astype(np.float32)
    return net


def training_rows(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int = TRAIN_ROWS
) -> tuple[list[bytes], list[int]]:
    """A bounded sample of labelled texts outside the held-out rows.

    A text that does not fit into what is left of ``TRAIN_BYTES`` is passed over, those after it
    are not. Rows of both labels of which only one fits raise an error.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    # ``most`` keys: small enough to be sent to every task.
    known = known.orderBy(F.xxhash64("_key"), "_key").limit(most)
    rows = docs.select(docs[key].alias("_key"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    rows = rows.join(F.broadcast(known), "_key").orderBy(F.xxhash64("_key"), "_key", "_text").limit(most)
    texts, marks, size, seen = [], [], 0, set()
    for row in rows.select(F.col("_text").cast("binary").alias("t"), "_label").toLocalIterator():
        seen.add(row["_label"])
        if size + len(row["t"]) > TRAIN_BYTES:
            continue
        size += len(row["t"])
        texts.append(bytes(row["t"]))
        marks.append(row["_label"])
    if len(set(marks)) < len(seen):
        raise ValueError(f"no labelled text of each label fits into {TRAIN_BYTES} bytes")
    return texts, marks


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"):
    return fit(*training_rows(docs, labels, key, text, label))


def score(docs: DataFrame, net: dict[str, np.ndarray] | None, text: str = "text", into: str = "score") -> DataFrame:
    """The input with one more column, the probability of label 1; a column of that name is replaced."""
    docs = docs.drop(into)
    if net is None:
        return docs.withColumn(into, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some ten thousand numbers
    names = docs.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, PART_BYTES):
                values = scores(shared.value, *text_bytes(part.column(text)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())], [*names, into])

    fields = [f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema]
    return docs.mapInArrow(scored, ", ".join([*fields, f"`{into}` double"]))
