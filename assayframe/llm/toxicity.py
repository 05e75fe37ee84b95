"""A convolutional text classifier with hashed word embeddings.

A word's embedding joins the rows that hashes of the word and of its first four, five and six
bytes choose in four tables, so inflected forms share most of it. One column of each table
starts as the smoothed log ratio of the row's document counts by class, the others at random.
Filters of several widths slide over the words, each keeps its largest value per text, and a
logistic unit weighs those (Kim, 2014). Rows that few texts use are not trained. Scores are
calibrated by language, which is told from the text itself: a threshold is chosen on rows set
apart for each language that has enough of them, and scores are shifted so that it falls on the
common threshold.

All labelled rows count. A hash of the key deals them into shards of some ``SHARD`` rows, which
are written once. Spark sums the counts by class of all shards; then each pass trains every
shard from the same net in a task of its own, and the shards' nets are averaged (local steps
with parameter averaging), a table's row over the shards that moved it. Sums are of whole
numbers, so they don't depend on the order of tasks. Thresholds are exact: errors are summed
along the sorted scores of all rows set apart, in ranges of scores whose counts add up. The
driver gets the tables' counts and the averaged net, both of fixed size.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import bound_batches, settle
from .fitting import NAMES, SCORED_BYTES, add_score, labelled_rows, remainder
from .text import Words, map_arrow, slices

#: First bytes of a word that a table hashes (None: all), rows per table, columns per row,
#: filter widths, filters of each width.
PARTS, ROWS, COLUMNS, WIDTHS, FILTERS = (None, 4, 5, 6), 1 << 16, 4, (1, 2, 3), 6
#: Texts that a row has to appear in to be trained, and weight of the prior in its log ratio.
FEWEST, PRIOR = 10, 4.0
#: Labelled rows of a shard, rows of a step, passes.
SHARD, STEP, PASSES = 4000, 32, 3
THRESHOLD = 0.3
#: How much worse a rejected clean row is than a missed one, as shares of their classes.
CAUTION = 3
#: Rows of each class that a language needs for a threshold of its own.
_ENOUGH = 20
#: Ranges of scores a unit is cut into, and the scale of numbers that are summed as whole ones.
_RANGES, _SCALE = 256, 2.0 ** 36

#: Frequent words that tell a language.
LANGUAGES = {
    "en": ["the", "and", "of", "to", "in", "is", "that", "it", "for", "was", "with", "are"],
    "fr": ["le", "les", "des", "et", "une", "du", "est", "dans", "qui", "pour", "sur", "pas"],
    "de": ["der", "die", "und", "den", "das", "ist", "nicht", "mit", "dem", "ein", "auf", "zu"],
    "es": ["el", "los", "que", "y", "las", "por", "una", "con", "para", "del", "se", "no"],
}

#: Letters, digits and all bytes of non-ASCII characters make words.
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True


def _hashes_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), _INSIDE).hashes(lower=True)


def words_of(data: np.ndarray, at: np.ndarray):
    """(hashes, slots, first): lower-case words of each text, the rows of the tables they
    choose (tables x words), and where each text's words begin."""
    words = Words(data, at, _INSIDE)
    found = words.several_hashes(True, PARTS)
    return found[0], np.stack([slots_of(h) for h in found]), words.first


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(33)).astype(np.int64) % ROWS


def language_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the number of its language in ``LANGUAGES``, or their count if none shows."""
    total = np.zeros((len(LANGUAGES) + 1, len(first) - 1), np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for i, words in enumerate(LANGUAGES.values()):
        known = np.isin(hashes, _hashes_of(" ".join(words)))
        total[i] = np.bincount(doc[known], minlength=len(first) - 1)
    best = total.argmax(0)
    return np.where(total.max(0) > 0, best, len(LANGUAGES))


class Net:
    """Tables, filters (width x embedding x filters), their shifts, weights and a bias."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        wide = len(PARTS) * COLUMNS
        self.tables = rng.normal(0, 0.05, (len(PARTS), ROWS, COLUMNS)).astype(np.float32)
        self.filters = [rng.normal(0, (1 / (w * wide)) ** 0.5, (w, wide, FILTERS))
                        .astype(np.float32) for w in WIDTHS]
        for f in self.filters:  # what is told by a ratio counts for it
            f[:, ::COLUMNS] = np.abs(f[:, ::COLUMNS])
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.weight = np.full(FILTERS * len(WIDTHS), 0.3, np.float32)
        self.bias = np.full(1, -1, np.float32)

    def pooled(self, slots: np.ndarray, first: np.ndarray):
        """(values, places): the largest value of each filter per text, and the word where it
        begins (-1 where none is above zero or the text is shorter than the filter)."""
        n, words = len(first) - 1, slots.shape[1]
        values = np.zeros((n, FILTERS * len(WIDTHS)), np.float32)
        places = np.full(values.shape, -1, np.int64)
        e = np.concatenate([t[s] for t, s in zip(self.tables, slots, strict=True)], axis=1)
        for k, width in enumerate(WIDTHS):
            total = np.repeat(self.shift[k][None], max(words - width + 1, 0), axis=0)
            for j in range(width):
                total += e[j:j + len(total)] @ self.filters[k][j]
            # Filters never reach into the next text.
            size = np.diff(first) - width + 1
            full = np.flatnonzero(size > 0)
            if len(full) == 0:
                continue
            keep = np.repeat(first[full] - np.cumsum(size[full]) + size[full], size[full]) \
                + np.arange(size[full].sum())
            inside = total[keep]
            begin = np.cumsum(size[full]) - size[full]
            top = np.maximum.reduceat(inside, begin, axis=0)
            here = slice(k * FILTERS, (k + 1) * FILTERS)
            values[full, here] = np.maximum(top, 0)
            owner = np.repeat(np.arange(len(full)), size[full])
            for f in range(FILTERS):
                hit = np.flatnonzero(inside[:, f] == top[owner, f])[::-1]
                spot = np.empty(len(full), np.int64)
                spot[owner[hit]] = keep[hit]
                places[full, k * FILTERS + f] = np.where(top[:, f] > 0, spot, -1)
        return values, places

    def logits(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The text's score before the logistic curve. Filters are applied to the tables, so a
        word only gathers their results."""
        n, words = len(first) - 1, slots.shape[1]
        out = np.full(n, self.bias[0], np.float64)
        for k, width in enumerate(WIDTHS):
            size = np.diff(first) - width + 1
            full = np.flatnonzero(size > 0)
            if len(full) == 0:
                continue
            total = np.repeat(self.shift[k][None], words - width + 1, axis=0)
            for j in range(width):
                for t in range(len(PARTS)):
                    part = slice(t * COLUMNS, (t + 1) * COLUMNS)
                    values = self.tables[t] @ self.filters[k][j, part]
                    total += values[slots[t, j:j + len(total)]]
            keep = np.ones(len(total), bool)
            for j in range(1, width):  # the last words of a text begin no whole filter
                edge = first[1:] - j
                keep[edge[(edge >= 0) & (edge < len(keep))]] = False
            total[~keep] = 0  # zero never beats the rectified value
            begin = np.minimum(first[:-1], len(total) - 1)[full]
            # Runs from one text's first word to the next one's: shorter texts in between
            # only add zeros.
            top = np.maximum(np.maximum.reduceat(total, begin, axis=0), 0)
            out[full] += top @ self.weight[k * FILTERS:(k + 1) * FILTERS]
        return out


class Training:
    """A net in training: ``trained`` rows, Adam's and Adagrad's sums, steps so far."""

    def __init__(self, seen: np.ndarray, many: np.ndarray, seed: int = 3):
        """``seen``: texts by table, class and row of the table; ``many``: texts by class."""
        self.net, self.state, self.count, self.many = Net(seed), {}, 0, many
        self.trained = seen.sum(1) >= FEWEST
        for t in range(len(PARTS)):
            clear, toxic = ((seen[t, c] + PRIOR * many[c] / many.sum()) / many[c] for c in (0, 1))
            self.net.tables[t, :, 0] = np.log(toxic / clear) / 2
            self.net.tables[t, ~self.trained[t], 1:] = 0
        self.squares = np.full((len(PARTS), ROWS, 1), 1e-8, np.float32)

    def passes(self) -> int:
        return max(PASSES, min(30, -(-6_000 // int(self.many.sum()))))

    def learn(self, texts: list[np.ndarray], label: np.ndarray, rng, passes: int) -> None:
        """Passes over texts given as slots (tables x words). Only the words under a filter's
        largest value get a gradient; each table row keeps its own sum of squares (Adagrad)."""
        net = self.net
        weigh = self.many.sum() / (2 * self.many)[label]
        for _ in range(passes):
            order = rng.permutation(len(texts))
            for begin in range(0, len(order), STEP):
                chosen = order[begin:begin + STEP]
                self.count += 1
                slots = np.concatenate([texts[i] for i in chosen], axis=1)
                first = np.concatenate(([0], np.cumsum([texts[i].shape[1] for i in chosen])))
                values, places = net.pooled(slots, first)
                z = values @ net.weight + net.bias[0]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                d = ((p - label[chosen]) * weigh[chosen] / len(chosen)).astype(np.float32)
                back = np.where(places >= 0, d[:, None] * net.weight[None], 0).astype(np.float32)
                grown = self._adam("weight", values.T @ d + 1e-4 * net.weight)
                risen = self._adam("bias", np.array([d.sum()]))
                rows = [[] for _ in PARTS]
                steps = [[] for _ in PARTS]
                for k, width in enumerate(WIDTHS):
                    here = slice(k * FILTERS, (k + 1) * FILTERS)
                    row, f = np.nonzero(places[:, here] >= 0)
                    if len(row) == 0:
                        continue
                    at, g = places[:, here][row, f], back[:, here][row, f]
                    change = 1e-4 * net.filters[k]
                    for j in range(width):
                        e = np.concatenate([net.tables[t][slots[t, at + j]]
                                            for t in range(len(PARTS))], 1)
                        np.add.at(change[j].T, f, g[:, None] * e)
                        for t in range(len(PARTS)):
                            rows[t].append(slots[t, at + j])
                            part = slice(t * COLUMNS, (t + 1) * COLUMNS)
                            steps[t].append(g[:, None] * net.filters[k][j, part, f])
                    net.filters[k] -= self._adam(f"filters{k}", change)
                    net.shift[k] -= self._adam(
                        f"shift{k}", np.bincount(f, g, FILTERS).astype(np.float32))
                for t in range(len(PARTS)):
                    if rows[t]:
                        used, owner = np.unique(np.concatenate(rows[t]), return_inverse=True)
                        total = np.zeros((len(used), COLUMNS), np.float32)
                        np.add.at(total, owner, np.concatenate(steps[t]))
                        used, total = used[self.trained[t, used]], total[self.trained[t, used]]
                        self.squares[t][used] += (total ** 2).mean(1, keepdims=True)
                        net.tables[t][used] -= 0.02 * total / np.sqrt(self.squares[t][used])
                net.weight -= grown
                net.bias -= risen

    def _adam(self, name: str, gradient: np.ndarray) -> np.ndarray:
        m, v = self.state.setdefault(name, (np.zeros_like(gradient), np.zeros_like(gradient)))
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient ** 2
        self.state[name] = (m, v)
        return (0.01 * (m / (1 - 0.9 ** self.count))
                / (np.sqrt(v / (1 - 0.99 ** self.count)) + 1e-8)).astype(np.float32)

    def dense(self) -> list[tuple[np.ndarray, str]]:
        """Everything but the tables, with the names of its sums in ``state``."""
        net = self.net
        return [(net.weight, "weight"), (net.bias, "bias"),
                *[(f, f"filters{k}") for k, f in enumerate(net.filters)],
                *[(b, f"shift{k}") for k, b in enumerate(net.shift)]]

    def changes(self, before: Training):
        """(table, row, scaled values, scaled root of the sum of squares) of the rows of tables
        that differ from ``before``; the rest under table -1: value, Adam's mean and root."""
        out = []
        for t in range(len(PARTS)):
            row = np.flatnonzero((self.net.tables[t] != before.net.tables[t]).any(axis=1))
            out.append((np.full(len(row), t), row, self.net.tables[t][row],
                        np.sqrt(self.squares[t][row, 0])))
        flat = np.concatenate([np.stack([value.ravel(), *self._sums(name, value)], axis=1)
                               for value, name in self.dense()])
        out.append((np.full(len(flat), -1), np.arange(len(flat)),
                    np.pad(flat, ((0, 0), (0, COLUMNS - 3))), np.zeros(len(flat))))
        table, row, value, root = (np.concatenate(x) for x in zip(*out, strict=True))
        whole = np.rint(np.column_stack([value, root]).astype(np.float64) * _SCALE)
        return [table, row, *whole.astype(np.int64).T]

    def _sums(self, name: str, like: np.ndarray):
        m, v = self.state.get(name, (np.zeros_like(like), np.zeros_like(like)))
        return m.ravel(), np.sqrt(v).ravel()

    def take(self, table: np.ndarray, row: np.ndarray, value: np.ndarray, steps: int) -> None:
        """Goes on from averaged ``changes`` after ``steps`` steps of a shard."""
        value = (value / _SCALE).astype(np.float32)
        for t in range(len(PARTS)):
            own = table == t
            self.net.tables[t][row[own]] = value[own, :COLUMNS]
            self.squares[t][row[own], 0] = np.maximum(value[own, COLUMNS] ** 2, 1e-8)
        flat, at = value[table == -1][np.argsort(row[table == -1])], 0
        for old, name in self.dense():
            part = flat[at:at + old.size]
            old[...] = part[:, 0].reshape(old.shape)
            self.state[name] = (part[:, 1].reshape(old.shape).copy(),
                                (part[:, 2] ** 2).reshape(old.shape))
            at += old.size
        self.count += steps


def _logits(net: Net, texts: list[np.ndarray]) -> np.ndarray:
    """Scores of many texts, some hundred at a time."""
    out = []
    for i in range(0, len(texts), 200):
        part = texts[i:i + 200]
        first = np.concatenate(([0], np.cumsum([t.shape[1] for t in part])))
        out.append(net.logits(np.concatenate(part, axis=1), first))
    return np.concatenate(out)


def _shards(rows: DataFrame) -> DataFrame:
    """(shard, label, text): the rows of each shard as arrays, by key."""
    many = max(1, -(-rows.count() // SHARD))  # counted without the texts
    shard = F.pmod(F.xxhash64("key"), F.lit(many))
    held = F.sort_array(F.collect_list(F.struct("key", "label", "text")))
    return settle(rows.groupBy(shard.alias("shard")).agg(held.alias("rows")).select(
        "shard", F.col("rows.label").alias("label"), F.col("rows.text").alias("text")), "shards",
        codec="zstd")


def _each_shard(batch: pa.RecordBatch):
    """(shard, slots of each text, labels, languages, flags of the rows set apart)."""
    for i, shard in enumerate(batch.column(0).to_pylist()):
        texts, langs = [], []
        for _, data, at in slices(batch.column(2)[i].values, SCORED_BYTES):
            hashes, slots, first = words_of(data, at)
            texts += [slots[:, i:j].astype(np.int32)
                      for i, j in zip(first[:-1], first[1:], strict=True)]
            langs.append(language_of(hashes, first))
        label = batch.column(1)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
        apart = np.random.default_rng([5, shard]).permutation(len(label)) % 5 == 0
        yield shard, texts, label, np.concatenate(langs), apart


def _counted(shards: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all shards: texts by table, class and row; rows to train on and apart by class."""

    def run(batch: pa.RecordBatch):
        for _, texts, label, _, apart in _each_shard(batch):
            for t in range(len(PARTS)):
                seen = np.zeros((2, ROWS), np.int64)
                for text, y in zip((x for x, a in zip(texts, apart, strict=True) if not a),
                                   label[~apart], strict=True):
                    seen[y][np.unique(text[t])] += 1
                row = np.flatnonzero(seen.any(axis=0))
                yield [np.full(len(row), t), row, seen[0, row], seen[1, row]]
            for i, chosen in enumerate((~apart, apart)):
                yield [[-1], [i], *[[int((label[chosen] == c).sum())] for c in (0, 1)]]

    found = map_arrow(shards, run, "t long, i long, clear long, toxic long").groupBy("t", "i").agg(
        F.sum("clear").alias("clear"), F.sum("toxic").alias("toxic")).toPandas()
    seen, many = np.zeros((len(PARTS), 2, ROWS)), np.zeros((2, 2), np.int64)
    for t, i, *n in found[found["t"] < 0].to_numpy():
        many[i] = n
    own = found[found["t"] >= 0]
    for c, name in enumerate(("clear", "toxic")):
        seen[own["t"], c, own["i"]] = own[name]
    return seen, many[0], many[1]


def _pass(shards: DataFrame, training: Training, number: int, passes: int, seed: int) -> None:
    """One round: every shard learns from the same net, which takes on their average."""

    def run(batch: pa.RecordBatch):
        for shard, texts, label, _, apart in _each_shard(batch):
            own = copy.deepcopy(training)
            own.learn([t for t, a in zip(texts, apart, strict=True) if not a], label[~apart],
                      np.random.default_rng([seed, number, shard]), passes)
            found = own.changes(training)
            yield [*found, np.full(len(found[0]), own.count - training.count)]

    values = [f"v{i}" for i in range(COLUMNS + 1)]
    schema = f"t long, i long, {', '.join(f'{v} long' for v in values)}, steps long"
    found = map_arrow(shards, run, schema).groupBy("t", "i").agg(
        *[(F.sum(v) / F.count("*")).alias(v) for v in values],
        F.max("steps").alias("steps")).toPandas()
    training.take(found["t"].to_numpy(), found["i"].to_numpy(), found[values].to_numpy(),
                  int(found["steps"].max()))


def _limits(scored: DataFrame) -> tuple[float, dict[int, float]]:
    """The threshold of all rows of (lang, label, z), and of languages with enough of them: the
    logit with the least share of missed rows of class 1 plus ``CAUTION`` times that of clean
    rows it would reject, midway in the widest such gap. Rows are ordered within short ranges of
    scores, whose counts add up to what lies below."""
    each = scored.select(F.explode(F.array(F.lit(-1), "lang")).alias("scope"), "z", "label") \
        .groupBy("scope", "z").agg(F.sum("label").alias("toxic"),
                                   F.count_if(F.col("label") == 0).alias("clear")) \
        .withColumn("range", F.floor(F.col("z") * _RANGES))
    order, whole = Window.partitionBy("scope").orderBy("range"), Window.partitionBy("scope")
    start = Window.unboundedPreceding

    def below(column, window):
        return F.coalesce(F.sum(column).over(window.rowsBetween(start, -1)), F.lit(0))

    ranges = each.groupBy("scope", "range").agg(
        F.sum("toxic").alias("toxic"), F.sum("clear").alias("clear"), F.max("z").alias("z")).select(
        "scope", "range", below("toxic", order).alias("toxic_below"),
        below("clear", order).alias("clear_below"), F.lag("z").over(order).alias("z_below"),
        F.sum("toxic").over(whole).alias("all_toxic"),
        F.sum("clear").over(whole).alias("all_clear"), F.max("z").over(whole).alias("last"))
    inside = Window.partitionBy("scope", "range").orderBy("z")
    last = F.coalesce(F.lag("z").over(inside), "z_below")
    missed = (F.col("toxic_below") + below("toxic", inside)) / F.greatest("all_toxic", F.lit(1))
    false = (F.col("all_clear") - F.col("clear_below") - below("clear", inside)) \
        / F.greatest("all_clear", F.lit(1))
    best = each.join(ranges, ["scope", "range"]).select(
        "scope", "all_toxic", "all_clear", "last", F.struct(
            F.round(missed + CAUTION * false, 12).alias("errors"),
            -F.coalesce(F.col("z") - last, F.lit(0.0)).alias("gap"),
            F.coalesce((F.col("z") + last) / 2, F.col("z") - 1).alias("edge")).alias("cut")) \
        .groupBy("scope").agg(F.min("cut").alias("cut"), F.first("all_toxic").alias("toxic"),
                              F.first("all_clear").alias("clear"), F.first("last").alias("last"))
    # Above the last score all of class 1 is missed.
    found = {r["scope"]: (r["last"] + 1 if min(r["toxic"], 1) < r["cut"]["errors"]
                          else r["cut"]["edge"], min(r["toxic"], r["clear"]))
             for r in best.collect()}
    return found[-1][0], {k: v for k, (v, n) in found.items() if k >= 0 and n >= _ENOUGH}


def train(rows: DataFrame, seed: int = 3) -> tuple[Net | None, np.ndarray]:
    """(net, logit thresholds by language) from (key, text, label), all rows of it."""
    shards = _shards(rows)
    seen, many, apart = _counted(shards)
    if min(many + apart) == 0:
        sure = 20.0 if (many + apart)[1] == 0 else -20.0
        return None, np.full(len(LANGUAGES) + 1, sure if (many + apart).any() else 0.0)
    training = Training(seen, np.maximum(many, 1), seed)
    alone = shards.count() == 1
    for number in range(1 if alone else PASSES):
        _pass(shards, training, number, training.passes() if alone else 1, seed)
    net, every = training.net, min(apart) < 3

    def run(batch: pa.RecordBatch):
        for _, texts, label, lang, apart in _each_shard(batch):
            chosen = np.flatnonzero(apart | every)
            if len(chosen):
                yield [lang[chosen], label[chosen], _logits(net, [texts[i] for i in chosen])]

    common, own = _limits(settle(map_arrow(shards, run, "lang int, label long, z double"), "apart"))
    return net, np.array([own.get(i, common) for i in range(len(LANGUAGES) + 1)])


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
             text: str = "text", modulus: int = 4, held: int = 2, threshold: float = THRESHOLD,
             names: tuple[str, str, str] = NAMES) -> DataFrame:
    """Every row of ``docs`` with all its columns, held_out, score and predicted (``names``).

    Fitted on all labelled rows whose crc32(key) modulo ``modulus`` isn't ``held``; scores read
    nothing but the text. Null and empty texts get the score of a text without any hit. Without
    labels of both classes every score is the same. Columns of these names in ``docs`` are
    replaced.
    """
    bound_batches(docs.sparkSession)
    net, limits = train(labelled_rows(docs, labels, label, key, modulus, held, text))
    columns = [c for c in docs.columns if c not in names]
    base = docs.select(*[docs[c] for c in columns])
    aim = float(np.log(threshold / (1 - threshold)))

    def score(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        hashes, slots, first = words_of(data, at)
        z = net.logits(slots, first) if net is not None else np.zeros(len(at) - 1)
        z = z - limits[language_of(hashes, first)] + aim
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    scored = add_score(base, text, names[1], score)
    return scored.select(*columns, (remainder(key, modulus) == held).alias(names[0]), names[1],
                         (F.col(names[1]) >= threshold).cast("int").alias(names[2]))
