"""Language identification by a bidirectional gated recurrent network over bytes, trained here in numpy.

The network reads the bytes of a whole text forwards and backwards, its state running from one end to the other, and gives every
position a distribution over the languages. A text's distribution is the mean over all its positions. Training is
backpropagation through time with Adam, over the whole texts of a bounded sample of labelled rows (``ROWS_A_LANGUAGE`` a language),
truncated after ``TRUNCATE`` bytes.

A recurrent state has to be computed byte after byte, so texts are cut into chunks that run side by side, as columns of a matrix. All chunks run from
state zero first. Then each chunk whose start isn't the end state of the one before it runs again from there, until its state is within ``CLOSE`` of what it was
at the same place before, and so on until no start is off. So what comes out is the state over the whole text, wherever the chunks' borders are. A text over a
block's bytes is run block after block, forwards to know the state at each border, then backwards: memory is bounded whatever its length.

Cases: ``und`` with score 0 where the text is null or has no letter, and for all texts where there is nothing to learn from. Ties go to
the first language by name. Repeated rows get equal answers up to rounding; an empty table gives an empty result; rows with a null id count as outside the
held-out fold; lang, source and ids never reach a prediction. Any script will do, as bytes have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.llm.common import fold, texts_of, with_id_type

HIDDEN = 8
ROWS_A_LANGUAGE = 250
#: Labels that differ more aren't languages; they raise an error.
MOST_LANGUAGES = 1000
SPARE = 8
EPOCHS = 2
BATCH = 256
RATE = 0.03
TRUNCATE = 64
CHUNK, STRIDE, CLOSE = 512, 32, 0.05
FOLDS, HELD_OUT = 4, 2
#: Floats of hidden states or class scores that a block of text may take: its bytes are this by the wider of the two.
_FLOATS = 6_000_000


class Network:
    """Bidirectional gated recurrent units over bytes, a softmax at every position. Matrices have a column a sequence."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
        self.classes, self.hidden, self.p = list(classes), hidden, {}
        for way in "fb":
            # x: what a byte adds to the update gate, the reset gate and the new state, biases included; u: what the state adds; o: to the classes
            self.p |= {f"x{way}": small(3 * hidden, 256), f"u{way}": small(3 * hidden, hidden), f"o{way}": small(len(classes), hidden)}
        self.p["d"] = np.zeros((len(classes), 1), np.float32)

    def learn(self, data: np.ndarray, lengths: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """Mean loss over the positions of sequences (columns of data, longest first) with their classes, and its gradients by backpropagation through time."""
        H, (steps, n) = self.hidden, data.shape
        live = (lengths[None, :] > np.arange(steps)[:, None]).sum(axis=1)
        real = (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32)
        kind, kept, out = next(iter(self.p.values())).dtype, {}, {}
        for w in "fb":
            x, u = self.p[f"x{w}"], self.p[f"u{w}"]
            h, out[w], kept[w] = np.zeros((H, n), kind), np.zeros((steps, H, n), kind), []
            for t in range(steps) if w == "f" else range(steps - 1, -1, -1):
                k = live[t]
                was = h[:, :k].copy()
                a, b = x[:, data[t, :k]], u @ was
                zr = 0.5 * np.tanh(0.5 * (a[: 2 * H] + b[: 2 * H])) + 0.5
                m = np.tanh(a[2 * H :] + zr[H:] * b[2 * H :])
                h[:, :k] = m + zr[:H] * (was - m)
                out[w][t, :, :k] = h[:, :k]
                kept[w].append((t, k, was, zr, m, b[2 * H :]))
        score = self.p["of"] @ out["f"] + self.p["ob"] @ out["b"] + self.p["d"]
        score -= score.max(axis=1, keepdims=True)
        prob = np.exp(score)
        prob /= prob.sum(axis=1, keepdims=True)
        own = prob[:, target, np.arange(n)]
        loss = float(-(np.log(own + 1e-9) * real).sum() / real.sum())
        e = prob
        e[:, target, np.arange(n)] -= 1
        e *= (real / real.sum())[:, None, :]
        g = {"d": e.sum(axis=(0, 2))[:, None]}
        for w in "fb":
            u, back = self.p[f"u{w}"], self.p[f"o{w}"].T @ e
            g[f"o{w}"] = np.einsum("tcn,thn->ch", e, out[w])
            gu, dh, moved, read = np.zeros_like(u), np.zeros((H, n), kind), [], []
            for t, k, was, zr, m, b in reversed(kept[w]):
                z, r = zr[:H], zr[H:]
                d = dh[:, :k] + back[t, :, :k]
                dm = d * (1 - z) * (1 - m * m)
                dz = d * (was - m) * z * (1 - z)
                dr = dm * b * r * (1 - r)
                db = np.concatenate([dz, dr, dm * r])
                moved.append(np.concatenate([dz, dr, dm]))
                read.append(data[t, :k])
                gu += db @ was.T
                dh[:, :k] = d * z + u.T @ db
            moved, read = np.concatenate(moved, axis=1), np.concatenate(read)
            g[f"x{w}"] = np.stack([np.bincount(read, row, 256) for row in moved])
            g[f"u{w}"] = gu
        return loss, g


def columns(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes as columns, lengths, order): longest first."""
    lengths = np.array([len(p) for p in parts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    data = np.zeros((int(lengths.max(initial=0)), len(parts)), np.uint8)
    for column, k in enumerate(order):
        data[: lengths[k], column] = np.frombuffer(parts[k], np.uint8)
    return data, lengths[order], order


def train(texts: list[bytes], langs: list[str], epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 7) -> Network | None:
    """A network from whole texts and the language of each; every language weighs the same. None without a byte to learn from."""
    parts = [t[a : a + TRUNCATE] for t in texts for a in range(0, len(t), TRUNCATE)]
    named = [lang for t, lang in zip(texts, langs, strict=True) for _ in range(0, len(t), TRUNCATE)]
    classes = sorted(set(named))
    if not classes:
        return None
    net, rng = Network(classes, seed=seed), np.random.default_rng(seed)
    number = {c: k for k, c in enumerate(classes)}
    label = np.array([number[x] for x in named])
    groups = [np.flatnonzero(label == c) for c in range(len(classes))]
    most = max(len(g) for g in groups)
    first, second, step = {k: 0.0 for k in net.p}, {k: 0.0 for k in net.p}, 0
    rounds = epochs * -(-most * len(groups) // batch)
    for _ in range(epochs):
        mixed = np.concatenate([np.concatenate([g, rng.choice(g, most - len(g))]) for g in groups])
        rng.shuffle(mixed)
        for k in range(0, len(mixed), batch):
            own = mixed[k : k + batch]
            data, lengths, order = columns([parts[i] for i in own])
            _, g = net.learn(data, lengths, label[own[order]])
            step += 1
            now = rate * (1 - step / (rounds + 1))
            for name, d in g.items():
                d = np.clip(d, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * d
                second[name] = 0.99 * second[name] + 0.01 * d * d
                net.p[name] -= (now * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


class Reader:
    """Sums of the position distributions of texts."""

    def __init__(self, net: Network, chunk: int = CHUNK, stride: int = STRIDE, close: float = CLOSE, floats: int = _FLOATS):
        self.net, self.chunk, self.stride, self.close = net, chunk, stride, close
        self.most = max(4 * chunk, floats // max(net.hidden, len(net.classes)))
        half = np.r_[np.full(2 * net.hidden, 0.5), np.ones(net.hidden)].astype(np.float32)[:, None]  # both gates by one tanh
        self.x = {w: np.ascontiguousarray(net.p[f"x{w}"] * half) for w in "fb"}
        self.u = {w: np.ascontiguousarray(net.p[f"u{w}"] * half) for w in "fb"}

    def _steps(self, way: str, data: np.ndarray, h: np.ndarray, live: np.ndarray) -> np.ndarray:
        """The states (step, unit, column) after each row of data, from the states h; at step t the first live[t] columns still run."""
        H, x, u = self.net.hidden, self.x[way], self.u[way]
        out = np.zeros((len(data), *h.shape), np.float32)
        k = 0
        for t in range(len(data)):
            if live[t] != k:
                k = int(live[t])
                h = h[:, :k].copy()
                a, b, zr, m = (np.empty((y * H, k), np.float32) for y in (3, 3, 2, 1))
            np.take(x, data[t, :k], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=b)
            a[: 2 * H] += b[: 2 * H]
            np.tanh(a[: 2 * H], out=zr)
            zr *= 0.5
            zr += 0.5
            np.multiply(zr[H:], b[2 * H :], out=m)
            m += a[2 * H :]
            np.tanh(m, out=m)
            h -= m
            h *= zr[:H]
            h += m
            out[t, :, :k] = h
        return out

    def _run(self, way: str, data: np.ndarray, sizes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class scores (class, position) that this way adds over texts that stand one after another, from a start state each; and their end states."""
        C, S, o = self.chunk, self.stride, self.net.p[f"o{way}"]
        each = -(-sizes // C)
        text = np.repeat(np.arange(len(sizes)), each)
        at = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
        sized = np.minimum(C, sizes[text] - at * C)
        real = np.flatnonzero(np.arange(C) < sized[:, None])
        table = np.zeros(len(text) * C, np.uint8)
        table[real] = data
        table = table.reshape(-1, C)
        order = np.argsort(-sized, kind="stable")  # whole chunks first; the rest stop early
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        table, length, text, at = np.ascontiguousarray(table[order].T), sized[order], text[order], at[order]
        later = np.flatnonzero(at > 0)
        before = place[order[later] - 1]
        scores = np.empty((len(o), len(order), C), np.float32)
        marks = np.zeros((-(-C // S), self.net.hidden, len(order)), np.float32)  # the state after each stride
        h = np.where(at > 0, np.float32(0), start[:, text])
        todo, again = np.arange(len(order)), False
        while len(todo):
            cols, now = todo, h[:, todo]
            for k in range(len(marks)):
                cols = cols[: (length[cols] > k * S).sum()]
                if not len(cols):
                    break
                left = np.minimum(length[cols] - k * S, S)
                steps = int(left[0])
                out = self._steps(way, table[k * S : k * S + steps, cols] if again else table[k * S : k * S + steps, : len(cols)], now[:, : len(cols)], np.searchsorted(-left, -np.arange(steps), "left"))
                scores[:, order[cols], k * S : k * S + steps] = np.matmul(o, out).transpose(1, 2, 0)
                now = out[left - 1, :, np.arange(len(cols))].T
                moved = np.abs(now - marks[k][:, cols]).max(axis=0) > self.close
                marks[k][:, cols] = now
                if again:  # where the state is what it was, so is all that follows
                    cols, now = cols[moved], now[:, moved]
            end = marks[(length - 1) // S, :, np.arange(len(order))].T
            todo = later[np.abs(end[:, before] - h[:, later]).max(axis=0, initial=0) > self.close]
            h[:, later] = np.where(np.isin(later, todo), end[:, before], h[:, later])
            again = True
        final = start.copy()
        final[:, each > 0] = end[:, place[np.cumsum(each)[each > 0] - 1]]
        return scores.reshape(len(o), -1).take(real, axis=1), final

    def _sums(self, data: np.ndarray, sizes: np.ndarray, ahead: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the distributions of texts in one block, none of them empty, and the backward states at their beginnings."""
        score, _ = self._run("f", data, sizes, ahead)
        backward, begun = self._run("b", data[::-1], sizes[::-1], behind[:, ::-1])
        score += backward[:, ::-1]
        score += self.net.p["d"]
        score -= score.max(axis=0)
        np.exp(score, out=score)
        score /= score.sum(axis=0)
        return np.add.reduceat(score, np.cumsum(sizes) - sizes, axis=1, dtype=np.float64).T, begun[:, ::-1]

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Sums of one text of more than a block."""
        none = np.zeros((self.net.hidden, 1), np.float32)
        cuts = [data[a : a + self.most] for a in range(0, len(data), self.most)]
        ahead, behind, out = [none], none, np.zeros(len(self.net.classes))
        for x in cuts[:-1]:
            ahead.append(self._run("f", x, np.array([len(x)]), ahead[-1])[1])
        for x, h in zip(cuts[::-1], ahead[::-1], strict=True):
            sums, behind = self._sums(x, np.array([len(x)]), h, behind)
            out += sums[0]
        return out

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """Sums over all positions of each text, and how many there are: one row a text."""
        out = np.zeros((len(texts), len(self.net.classes) + 1), np.float64)
        held, of, size = [], [], 0

        def add() -> None:
            if held:
                sizes = np.array([len(x) for x in held])
                none = np.zeros((self.net.hidden, len(held)), np.float32)
                out[of, :-1] = self._sums(np.frombuffer(b"".join(held), np.uint8), sizes, none, none)[0]
                held.clear()
                of.clear()

        for k, text in enumerate(texts):
            raw = text.encode("utf-8", "surrogatepass") if text else b""
            out[k, -1] = len(raw)
            if len(raw) > self.most:
                out[k, :-1] = self._long(np.frombuffer(raw, np.uint8))
            elif raw:
                if size + len(raw) > self.most:
                    add()
                    size = 0
                held.append(raw)
                of.append(k)
                size += len(raw)
        add()
        return out


def sample_texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows_a_language: int = ROWS_A_LANGUAGE) -> tuple[list[bytes], list[str]]:
    """Whole texts and their languages: of each language the rows with the smallest hashes of id and text, ``rows_a_language`` at most."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = labelled.select(F.col(lang_col).alias("__lang"), F.xxhash64(F.col(id_col).cast("string")).alias("__i"))
    sizes = {r["__lang"]: r["count"] for r in known.groupBy("__lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return [], []
    # hashes are even, so the ids below this bound are about SPARE times as many as are wanted: the rows to rank are few, whatever the table's size
    bound = {lang: int(2**64 * min(1.0, SPARE * rows_a_language / n)) - 2**63 for lang, n in sizes.items()}
    below = F.create_map(*[F.lit(x) for lang, h in bound.items() for x in (lang, min(h, 2**63 - 1))])[F.col(lang_col)]
    near = labelled.where(F.xxhash64(F.col(id_col).cast("string")) <= below)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))  # Spark keeps rows_a_language a task before it shuffles, repeated rows too
    rows = near.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("h"), F.col(text_col).cast("string").cast("binary").alias("text"))
    got = rows.withColumn("n", first).where(F.col("n") <= rows_a_language).collect()  # rows_a_language a language at most
    got = sorted((r["h"], r["lang"], bytes(r["text"])) for r in got)
    return [t for _, _, t in got], [lang for _, lang, _ in got]


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score of every row."""
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    predict = predictor(net)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = predict()
        for batch in batches:
            langs, scores = judge(batch.iloc[:, 1].tolist())
            yield pd.DataFrame({id_col: batch.iloc[:, 0], "lang_pred": langs, "score": scores})

    return with_id_type(texts_of(docs, id_col, text_col).mapInPandas(work, schema), docs, id_col)


def predictor(net: Network | None):
    """A function for a worker to call once; it gives a function from texts to (languages, scores)."""

    def start():
        import regex

        letter, reader = regex.compile(r"\p{L}"), Reader(net) if net else None

        def judge(texts: list[str | None]) -> tuple[list[str], list[float]]:
            if reader is None:
                return ["und"] * len(texts), [0.0] * len(texts)
            sums = reader.documents(texts)
            prob = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
            best = prob.argmax(axis=1)
            spoken = [bool(t) and letter.search(t) is not None for t in texts]
            return [net.classes[b] if s else "und" for b, s in zip(best, spoken, strict=True)], [float(np.clip(prob[k, b], 0, 1)) if s else 0.0 for k, (b, s) in enumerate(zip(best, spoken, strict=True))]

        return judge

    return start


def held_out(id_col: str = "doc_id"):
    """Whether a row is in the held-out fold; no row with a null id is."""
    return F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network from the documents outside the held-out fold."""
    return train(*sample_texts(docs.where(~held_out(id_col)), id_col, text_col, lang_col))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: A trained network can't be written in SQL; tests hold gradients against differences, chunks against a plain run and predictions against held-out labels.
ORACLE_SQL = None
