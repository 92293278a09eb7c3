"""A hierarchical Pitman-Yor language model of words, learned from all training texts.

A word is drawn in the restaurant of the word before it, whose parent is that of the shorter, empty
context: the root. Every word has a restaurant, and so has the start of a text. Those of words with a
share of at least 1 / OWN_SHARE of the training tokens send their tables to the root. Those of rarer
words have the root's averaged probability as their base; each of their customers is one of the root's.
The root's base is uniform over the V training words and one for all others.

Seating is sampled by blocked Gibbs sweeps. All customers of a word leave a restaurant and are seated
again one by one, at its tables or at new ones, given the tables of all others; the new seating is
taken with the Metropolis-Hastings probability that corrects for the order of sitting down. Customers
between two new tables are drawn in one step, exactly, however many they are. A table's dish is a
customer of the parent. Words are seated side by side in tasks, so the other words' tables are those of
the pass before. The averaged predictive probability of SAMPLES seatings, after SETTLE sweeps, scores
a text. Discounts come from the counts of ones and twos.

Words are known by 63 bits of a hash. Counting, seating and rare words go by shuffles on the word, the
restaurants of rare words by one on the restaurant, none of which has more than a share of 1 / OWN_SHARE
of the tokens: blocks of what follows rare words, in training and in a scored text, meet in buckets.
Broadcast are the words with a share of 1 / OWN_SHARE, at most so many, the scores of the most frequent
words in the restaurants where they were seen, HEAD_SCORES numbers at most, and the probabilities of
COMMON words in the root. Tasks pack both for the driver, which gets a few rows of bytes. Draws depend
on word, restaurant and sweep alone, so no partitioning or lost executor changes them.

Defined results: null text is empty and has the end token only; a null doc_id is not held out;
rows that repeat count and are scored each; without training text every probability is 1; of equally
frequent words either all or none are broadcast; kept columns may have any name but those of the result.
"""

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext
from .arrowtext import U, Words, keys, mix
from .workspace import Workspace, ddl, partitions

OWN_SHARE = 2048
HEAD_WORDS = 1 << 16
HEAD_SCORES = 1 << 23
#: Words whose probability in the root is broadcast; others ask for it by the word.
COMMON = 1 << 20
SAMPLES, SETTLE, PASSES = 3, 1, 2
STRENGTH = 1.0
END = int(mix(np.array([0xE0D], U))[0] >> U(1))
#: Rows that are worth a step of array operations.
TOGETHER_ROWS = 48
#: Tokens that a task counts together before it passes the counts on.
TOGETHER = 4_000_000
#: Rows of a chunk of scored texts, at most; numbers of rows in it have 16 bits.
CHUNK_ROWS = 60_000
#: Keys of buckets of rare words' restaurants, and of words; those of texts are above both.
BUCKETS, WORDS = -(1 << 62), -(1 << 61)


def tokens(column, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, restaurant and row of every token of a column of texts, each text's end last; own: sorted words with restaurants of their own.

    Restaurant 0 is that of a text's start, those of own words follow, and the root is the last.
    """
    words = Words(*arrowtext.column(column), arrowtext.SPACE)
    stop = np.cumsum(words.count + 1)
    word = np.empty(int(stop[-1]) if len(stop) else 0, np.int64)
    row = np.repeat(np.arange(words.rows), words.count + 1)
    word[stop - 1] = END
    inner = np.ones(len(word), bool)
    inner[stop - 1] = False
    word[inner] = (words.hash >> U(1)).astype(np.int64)
    place = np.full(len(word), 1 + len(own))
    if len(own) and len(word):
        at = np.minimum(np.searchsorted(own, word[:-1]), len(own) - 1)
        hit = np.flatnonzero(own[at] == word[:-1])
        place[hit + 1] = 1 + at[hit]
    place[stop - words.count - 1] = 0
    return word, place, row


def _counted(texts: DataFrame, own: np.ndarray | None) -> DataFrame:
    """(word, place, n) of the tokens of texts, several times for a word if several tasks have it; without own all places are 0."""

    def flush(found):
        word, place = (np.concatenate(x) for x in zip(*found))
        names, number = np.unique(word, return_inverse=True)
        width = int(place.max(initial=0)) + 1
        pair, n = np.unique(number * width + place, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names[pair // width]), pa.array((pair % width).astype(np.int32)), pa.array(n.astype(np.int64))], ["word", "place", "n"])

    def run(batches):
        found, size = [], 0
        for part in arrowtext.slices(batches, "text"):
            word, place, _ = tokens(part.column(0), own if own is not None else np.zeros(0, np.int64))
            found.append((word, place if own is not None else np.zeros(len(word), np.int64)))
            size += len(word)
            if size >= TOGETHER:
                yield flush(found)
                found, size = [], 0
        if size:
            yield flush(found)

    return texts.mapInArrow(run, "word long, place int, n long")


@cache
def _key(seed: int) -> U:
    return keys(seed, 1)[0]


def _uniform(word: np.ndarray, place: np.ndarray, sweep: int, step) -> np.ndarray:
    x = mix(word.astype(U) ^ _key(31 + sweep) ^ mix((place + 1).astype(U) * _key(30) + np.asarray(step).astype(U)))
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def lgamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function of positive numbers, by Stirling's series eight places further on."""
    ends = x * (x + 7)  # eight factors, taken in pairs from both ends
    product = ends * (ends + 6)
    product *= ends + 10
    product *= ends + 12
    y = x + 8
    small = 1 / y
    square = small * small
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + small * (1 / 12 - square * (1 / 360 - square / 1260)) - np.log(product)


def _rise(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """ln of low * (low + 1) * ... * (high - 1), for differences that are whole."""
    step = np.rint(high - low).astype(np.int64)
    out = np.zeros(len(low))
    few = np.flatnonzero((step > 0) & (step <= 8))
    if few.size:
        product, at, left = low[few].copy(), low[few], step[few]
        for i in range(1, int(left.max())):
            on = np.flatnonzero(left > i)
            product[on] *= at[on] + i
        out[few] = np.log(product)
    many = np.flatnonzero(step > 8)
    if many.size:
        out[many] = lgamma(high[many]) - lgamma(low[many])
    return out


class Parent:
    """What the restaurant above gives a word: customers there but for this restaurant's tables, tables, discount, 1 / (strength + customers of all words), and the rest."""

    def __init__(self, others, tables, discount, scale, rest):
        self.others, self.tables, self.discount, self.scale, self.rest = others, tables, discount, scale, rest

    def __getitem__(self, rows) -> "Parent":
        return Parent(self.others[rows], self.tables[rows], self.discount, self.scale[rows], self.rest[rows])

    def given(self, own) -> np.ndarray:
        """The word's probability there while own tables here are its customers."""
        customers = self.others + own
        return np.maximum(customers - self.discount * np.minimum(self.tables, customers), 0) * self.scale + self.rest


def _new(discount: float, parent: Parent, others: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The weight of a new table in a restaurant that has others' tables and so many of the word's."""
    return (STRENGTH + discount * (others + tables)) * parent.given(tables)


class Seating:
    """n customers of each row, and rows and numbers of the customers who opened second, third... tables, in order."""

    def __init__(self, n: np.ndarray, row: np.ndarray, at: np.ndarray):
        order = np.lexsort((at, row))
        self.n, self.row, self.at = n, row[order], at[order]

    def tables(self) -> np.ndarray:
        return (self.n > 0) + np.bincount(self.row, minlength=len(self.n)).astype(np.int64)

    def weight(self, discount: float, parent: Parent, others: np.ndarray) -> np.ndarray:
        """ln of this seating's chance over that of seat() making it, but for a constant."""
        rows = np.flatnonzero(self.n > 1)
        row = np.concatenate([rows, self.row])  # a stretch of customers begins with the first or with an opener
        begin = np.concatenate([np.ones(len(rows), np.int64), self.at])
        order = np.lexsort((begin, row))
        row, begin = row[order], begin[order]
        head = np.diff(row, prepend=-1) > 0
        tables = np.arange(len(row)) - np.maximum.accumulate(np.where(head, np.arange(len(row)), 0)) + 1
        last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
        end = np.where(last, self.n[row], np.append(begin[1:], 0)) if len(row) else begin
        keep = end > begin
        row, begin, end, tables, last = row[keep], begin[keep], end[keep], tables[keep], last[keep]
        # and is cut where the customers have doubled, as seat() looks ahead anew there
        parts = np.ceil(np.log2(end / begin)).astype(np.int64)
        at = np.repeat(np.arange(len(row)), parts)
        k = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
        low = begin[at] << k
        high = np.minimum(low * 2, end[at])
        new, tilt = _new(discount, parent[row[at]], others[row[at]], tables[at]), self._tilt(row[at], low, tables[at], discount, parent, others)
        base = low - discount * tables[at] + new * np.exp(tilt)
        opened = (high == end[at]) & ~last[at]
        return np.bincount(row[at], _rise(base, base + (high - low)) - np.where(opened, tilt, 0.0), len(self.n))

    def _tilt(self, row, m, t, discount: float, parent: Parent, others: np.ndarray) -> np.ndarray:
        return _tilt(self.n[row], m, t, discount, parent[row], others[row])

    def chosen(self, other: "Seating", take: np.ndarray) -> "Seating":
        """This one with other's rows where take is set."""
        own, new = ~take[self.row], take[other.row]
        return Seating(self.n, np.concatenate([self.row[own], other.row[new]]), np.concatenate([self.at[own], other.at[new]]))

    def with_customers(self, n: np.ndarray, *given) -> "Seating":
        """The last ones leave or more are seated, until there are n; any order of customers is as likely, so this is a seating of n."""
        stay = self.at <= n[self.row]
        return seat(n, *given, begin=Seating(np.minimum(n, self.n), self.row[stay], self.at[stay]))


def _tilt(n, m, t, discount: float, parent: Parent, others) -> np.ndarray:
    """ln of how much less likely the customers after the next one are to be seated with one more table, all at tables."""
    one, two = (m + 1 - discount * x + _new(discount, parent, others, x) for x in (t, t + 1))
    left = np.maximum(n - m - 1, 0)
    return np.minimum(_rise(two, two + left) - _rise(one, one + left), 0.0)


def seat(n: np.ndarray, parent: Parent, others: np.ndarray, discount: float, word: np.ndarray, place: np.ndarray, sweep: int, begin: Seating | None = None) -> Seating:
    """n customers of each word seated one by one, after those of begin; others: tables of other words.

    A new table's weight is lessened by what it costs the customers still to come, as looked up when
    a table opens or the customers have doubled. Between such points the chance that none of the next
    j opens a table is a ratio of gamma functions, so the next one who does is found by halving,
    without a step for each customer. Rows step together while they are many, and by themselves then.
    """
    m, t = np.minimum(n, 1), np.minimum(n, 1)
    rows, at = [], []
    if begin is not None:
        m, t = np.maximum(begin.n, m), np.maximum(begin.tables(), t)
        rows, at = [begin.row], [begin.at]
    left, step = np.flatnonzero(n > m), 0
    m, t = m[left], t[left]
    while len(left):
        if len(left) < TOGETHER_ROWS and step:
            for i, m_, t_ in zip(left.tolist(), m.tolist(), t.tolist()):
                opened = _seat_one(int(n[i]), m_, t_, parent, i, float(others[i]), discount, word[i : i + 1], place[i : i + 1], sweep, step)
                rows.append(np.full(len(opened), i)), at.append(np.array(opened, np.int64))
            break
        low = m - discount * t
        above, beside = parent[left], others[left]
        new = _new(discount, above, beside, t) * np.exp(_tilt(n[left], m, t, discount, above, beside))
        limit = np.log(_uniform(word[left], place[left], sweep, step))
        start = lgamma(low + new) - lgamma(low)
        least, most = np.zeros(len(left), np.int64), np.minimum(n[left] - m, m)  # the opener comes after least and not after most
        opens = start + lgamma(low + most) - lgamma(low + new + most) <= limit
        while (wide := np.flatnonzero(opens & (most - least > 1))).size:
            middle = (least[wide] + most[wide]) // 2
            over = start[wide] + lgamma(low[wide] + middle) - lgamma(low[wide] + new[wide] + middle) <= limit[wide]
            most[wide], least[wide] = np.where(over, middle, most[wide]), np.where(over, least[wide], middle)
        m, t, step = m + most, t + opens, step + 1
        rows.append(left[opens]), at.append(m[opens])
        more = n[left] > m
        left, m, t = left[more], m[more], t[more]
    return Seating(n, *(np.concatenate([np.zeros(0, np.int64), *x]) for x in (rows, at)))


def _ratio(x: float, a: float) -> float:
    """ln of gamma(x + a) / gamma(x)."""
    if x < 1e6:
        return math.lgamma(x + a) - math.lgamma(x)
    return (x + a - 0.5) * math.log1p(a / x) + a * math.log(x) - a


def _seat_one(n: int, m: int, t: int, parent: Parent, i: int, others: float, discount: float, word: np.ndarray, place: np.ndarray, sweep: int, step: int) -> list[int]:
    """seat() for row i, from m customers at t tables on; the customers who open tables."""
    customers, tables, above = float(parent.others[i]), float(parent.tables[i]), parent.discount
    scale, rest, out, draws = float(parent.scale[i]), float(parent.rest[i]), [], []
    while m < n:
        if not draws:
            draws = np.log(_uniform(word, place, sweep, np.arange(step, step + 256, dtype=np.int64)))[::-1].tolist()
            step += 256
        weights = []
        for x in (t, t + 1):
            there = customers + x
            weights.append((STRENGTH + discount * (others + x)) * (max(there - above * min(tables, there), 0.0) * scale + rest))
        ahead = n - m - 1
        one, two = m + 1 - discount * t + weights[0], m + 1 - discount * (t + 1) + weights[1]
        tilt = min(_ratio(two, ahead) - _ratio(one, ahead), 0.0)
        new, low, limit, most = weights[0] * math.exp(tilt), m - discount * t, draws.pop(), min(n - m, m)
        start = _ratio(low, new)
        if start - _ratio(low + most, new) > limit:
            m += most
            continue
        wait = -limit / new  # for small weights the chance is that of a power law
        least, guess, wide = 0, 1 if wait < 1e-9 else int(min(most, low * math.expm1(min(wait, 50.0)) + 1)), 1
        while most - least > 1:
            guess = min(max(guess, least + 1), most - 1)
            if start - _ratio(low + guess, new) <= limit:
                most, guess = guess, max(guess - wide, (least + guess) // 2)
            else:
                least, guess = guess, min(guess + wide, (guess + most) // 2 + 1)
            wide *= 2
        m, t = m + most, t + 1
        out.append(m)
    return out


def sweep_once(now: Seating | None, n: np.ndarray, parent: Parent, others: np.ndarray, discount: float, word: np.ndarray, place: np.ndarray, sweep: int) -> Seating:
    """A Gibbs step for every word and restaurant: all of a word's customers leave and are seated again.

    Of two customers the second opens a table or not, whose chance is known; more go through seat().
    """
    two, many = np.flatnonzero(n == 2), np.flatnonzero(n > 2)
    new = _new(discount, parent[two], others[two], np.ones(len(two), np.int64))
    opens = two[_uniform(word[two], place[two], sweep, 0) < new / (1 - discount + new)]
    given = (parent[many], others[many], discount, word[many], place[many])
    made = seat(n[many], *given, sweep)
    if now is not None and len(many):
        before = Seating(now.n[many], *_within(now, many, len(n)))
        if (before.n != made.n).any():
            before = before.with_customers(made.n, *given, 1000 + sweep)
        # where both are the same, as most are, there is nothing to choose
        width = int(made.n.max()) + 1
        other = np.unique(np.setxor1d(made.row * width + made.at, before.row * width + before.at, assume_unique=True) // width)
        rows, weigh = many[other], lambda x: Seating(x.n[other], *_within(x, other, len(many))).weight(discount, parent[rows], others[rows])
        take = np.zeros(len(many), bool)
        take[other] = np.log(_uniform(word[rows], place[rows], 2000 + sweep, 0)) < weigh(made) - weigh(before)
        made = before.chosen(made, take)
    return Seating(n, np.concatenate([opens, many[made.row]]), np.concatenate([np.full(len(opens), 2), made.at]))


def _within(seating: Seating, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The openings of some rows, by their places among these."""
    number = np.full(n, -1)
    number[rows] = np.arange(len(rows))
    row = number[seating.row]
    return row[row >= 0], seating.at[row >= 0]


class Totals:
    """Of each sample, customers and tables of every restaurant (the root last), and the numbers the discounts need."""

    def __init__(self, rows, own: np.ndarray):
        self.own, self.root = own, 1 + len(own)
        self.customers, self.tables = np.zeros((2, SAMPLES, self.root + 1))
        self.words, share = 0, {0: 0.5, 1: 0.5}
        for r in rows:
            if r["place"] >= 0:
                self.customers[:, r["place"]], self.tables[:, r["place"]] = r["customers"], r["tables"]
            elif r["place"] == -1:
                self.words = int(r["customers"][0])
            else:
                ones, twos = r["customers"][0], r["customers"][1]
                share[-2 - r["place"]] = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        #: Of restaurants of words and of the root.
        self.discounts = [share[k] for k in range(2)]

    def scale(self) -> np.ndarray:
        """1 / (strength + customers), by sample and restaurant."""
        return 1 / (STRENGTH + self.customers)

    def back(self) -> np.ndarray:
        """The weight of the parent, by sample and restaurant."""
        discount = np.array(self.discounts)[(np.arange(self.root + 1) == self.root).astype(int)]
        return (STRENGTH + discount * self.tables) * self.scale()

    @property
    def uniform(self) -> float:
        return 1 / (self.words + 1)


_L, _N = pa.list_(pa.int64()), pa.list_(pa.float64())
_SCHEMA = pa.schema([("word", pa.int64()), ("count", pa.int64()), ("places", _L), ("counts", _L), ("tables", _L), ("root_customers", _L), ("root_tables", _L), ("place", pa.int32()), ("sums", _N), ("table_sums", _N)])
_MODEL = "word long, count long, places array<long>, counts array<long>, tables array<long>, root_customers array<long>, root_tables array<long>, place int, sums array<double>, table_sums array<double>"


def _gathered(batches, rows: int = 10_000):
    """Batches joined to about so many rows; a row here is a word's counts, one for each restaurant at most."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _lists(values: np.ndarray, size: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(values.astype(np.int64)))


def _seated(words: DataFrame, before: Totals | None, own: np.ndarray, brief: bool = False) -> DataFrame:
    """Rows of the model, and at the end of each partition rows of totals without a word; without totals before, every word has one table in a restaurant; brief: one seating stands for all samples."""
    root = 1 + len(own)

    def run(batches):
        customers, tables = np.zeros((2, SAMPLES, root + 1))
        total, ones = 0, np.zeros((2, 2))
        for batch in _gathered(batches, 40_000):
            rows, lists = batch.num_rows, batch.column(1)
            name = batch.column(0).to_numpy()
            owner = np.repeat(np.arange(rows), np.diff(lists.offsets.to_numpy()))
            place, n = lists.flatten().to_numpy().astype(np.int64), batch.column(2).flatten().to_numpy().astype(np.int64)
            order = np.lexsort((place, owner))
            owner, place, n = owner[order], place[order], n[order]
            count = np.bincount(owner, n, rows).astype(np.int64)
            leaf = place < root
            l_owner, l_place, l_n = owner[leaf], place[leaf], n[leaf]
            direct = np.bincount(owner[~leaf], n[~leaf], rows).astype(np.int64)
            t, t0 = np.ones(len(l_n), np.int64), np.ones(rows, np.int64)
            first = second = None
            kept = {k: [] for k in ("tables", "root_customers", "root_tables")}
            for sweep in range(SETTLE + SAMPLES if before is not None and not brief else SAMPLES):
                n0 = direct + np.bincount(l_owner, t, rows).astype(np.int64)
                if before is not None and not (brief and sweep > SETTLE):
                    d, d0 = before.discounts
                    scale, back, seats = before.scale().mean(axis=0)[root], before.back().mean(axis=0)[root], before.tables.mean(axis=0)
                    flat = np.ones(len(l_n))
                    above = Parent(n0[l_owner] - t, t0[l_owner], d0, scale * flat, back * before.uniform * flat)
                    first = sweep_once(first, l_n, above, np.maximum(seats[l_place] - t, 0), d, name[l_owner], l_place, sweep)
                    t = first.tables()
                    n0 = direct + np.bincount(l_owner, t, rows).astype(np.int64)
                    flat, none = np.ones(rows), np.zeros(rows, np.int64)
                    above = Parent(none, none, 0.0, 0.0 * flat, before.uniform * flat)
                    second = sweep_once(second, n0, above, np.maximum(seats[root] - t0, 0), d0, name, np.full(rows, root), sweep)
                    t0 = second.tables()
                if (s := sweep - (SETTLE if before is not None and not brief else 0)) >= 0:
                    for k, x in zip(kept, (t, n0, t0)):
                        kept[k].append(x)
                    customers[s] += np.bincount(l_place, l_n, root + 1)
                    tables[s] += np.bincount(l_place, t, root + 1)
                    customers[s, root] += n0.sum()
                    tables[s, root] += t0.sum()
            total += rows
            for k, x in enumerate((l_n, n0)):
                ones[k] += (x == 1).sum(), (x == 2).sum()
            flat = {k: np.stack(x, axis=1).ravel() for k, x in kept.items()}
            of_leaf, one = np.bincount(l_owner, minlength=rows), np.ones(rows, np.int64)
            columns = [batch.column(0), pa.array(count), _lists(l_place, of_leaf), _lists(l_n, of_leaf), _lists(flat["tables"], of_leaf * SAMPLES)]
            columns += [_lists(flat[k], one * SAMPLES) for k in ("root_customers", "root_tables")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(rows, f.type) for f in list(_SCHEMA)[len(columns) :])], schema=_SCHEMA)
        sums = [{"place": i, "sums": customers[:, i].tolist(), "table_sums": tables[:, i].tolist()} for i in range(root + 1)]
        sums.append({"place": -1, "sums": [float(total)] + [0.0] * (SAMPLES - 1), "table_sums": [0.0] * SAMPLES})
        sums += [{"place": -2 - k, "sums": [*map(float, x)] + [0.0] * (SAMPLES - 2), "table_sums": [0.0] * SAMPLES} for k, x in enumerate(ones)]
        yield pa.RecordBatch.from_pylist(sums, _SCHEMA)

    return words.mapInArrow(run, _MODEL)


def _summed(model: DataFrame, own: np.ndarray) -> Totals:
    part = lambda c: F.array(*(F.sum(F.get(c, F.lit(s))) for s in range(SAMPLES)))
    found = model.where("word is null").groupBy("place").agg(part("sums").alias("customers"), part("table_sums").alias("tables"))
    return Totals(found.collect(), own)  # a row for each restaurant, OWN_SHARE + 5 at most


class Common:
    """The most frequent words in order, how often each is there, and their probability in the root."""

    def __init__(self, word: np.ndarray, count: np.ndarray, p0: np.ndarray):
        self.word, self.count, self.p0 = word, count, p0
        self.bits = max(8, int(len(self.word) * 2).bit_length())
        self.slot = np.searchsorted(self.word >> (63 - self.bits), np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.slot).max(initial=0))

    def __reduce__(self):
        return Common, (self.word, self.count, self.p0)

    def find(self, word: np.ndarray) -> np.ndarray:
        """Numbers of words here, -1 for others."""
        out = np.full(len(word), -1, np.int32)
        if not len(self.word):
            return out
        at, left = self.slot[word >> (63 - self.bits)], np.arange(len(word))
        for _ in range(self.deepest):
            there = self.word[np.minimum(at, len(self.word) - 1)]
            hit = there == word[left]
            out[left[hit]] = at[hit]
            on = there < word[left]
            on &= at + 1 < len(self.word)
            left, at = left[on], at[on] + 1
            if not len(left):
                break
        return out


class Scores:
    """log10 of the averaged probability of words in restaurants: a number for each word and restaurant that has it, by a bit that says so; others ask the root.

    seen: words of 64 bits, so many for each word as hold its restaurants, value: in their order, p0: by sample and word, back: by sample and restaurant.
    """

    def __init__(self, seen: np.ndarray, value: np.ndarray, p0: np.ndarray, back: np.ndarray):
        self.seen, self.value, self.p0, self.back = seen, value, p0, back
        each = np.bitwise_count(seen)
        self.before = np.cumsum(each, dtype=np.int64) - each

    def __reduce__(self):
        return Scores, (self.seen, self.value, self.p0, self.back)

    def __call__(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        cell = word * (len(self.seen) // self.p0.shape[1] * 64) + place
        bits, at = self.seen[cell >> 6], (cell & 63).astype(U)
        rank = self.before[cell >> 6] + np.bitwise_count(bits & ((U(1) << at) - U(1)))
        hit = (bits >> at & U(1)).astype(bool)
        out = np.empty(len(cell), np.float32)
        out[hit] = self.value[rank[hit]]
        word, place = word[~hit], place[~hit]
        out[~hit] = np.log10((self.p0[:, word] * self.back[:, place]).mean(axis=0))
        return out


#: Columns of rows of the model as bytes; size: each word's number of places.
_PACKED = ["word", "count", "size", "places", "counts", "tables", "root_customers", "root_tables"]


def _unpacked_rows(packed, kind) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
    """Words, their counts and their rows for probability(), each with one more for a word never seen at the end but for the words."""
    column = lambda c, k: _joined(packed.column(packed.schema.get_field_index(c)), k)
    words, size = column("word", np.int64), np.append(column("size", np.uint16), 0).astype(np.int64)
    count, n = np.append(column("count", kind), 0).astype(np.int64), len(words)
    tables, root = column("tables", kind), {c: column(c, kind) for c in ("root_customers", "root_tables")}
    of_root = np.append(np.full(n, len(root["root_tables"]) // max(n, 1)), 0)
    made = {"count": pa.array(count, mask=np.arange(n + 1) == n), "places": _lists(column("places", np.uint16), size), "counts": _lists(column("counts", kind), size)}
    made |= {"tables": _lists(tables, size * (of_root[0] if n else 0))} | {c: _lists(x, of_root) for c, x in root.items()}
    return words, count, pa.RecordBatch.from_pydict(made)


def _packed_rows(columns, schema: str):
    """One row of bytes for some thousand rows of a model: columns gives each batch's arrays."""

    def run(batches):
        for batch in _gathered(batches):
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns(batch)], schema.split())

    return run, ", ".join(f"{c} binary" for c in schema.split())


class Model:
    """The table of words and the totals; head: the most frequent words' rows; rare: restaurants of rare words, a row for each bucket."""

    def __init__(self, work: Workspace, table: DataFrame, totals: Totals, tokens: int):
        self.work, self.table, self.totals, self.tokens = work, table, totals, tokens
        most = min(HEAD_WORDS, HEAD_SCORES // (totals.root + 1))
        level = F.floor(F.log2("count") * 8)
        seen, self.least, self.least_common = 0, None, None
        levels = table.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("count").alias("least"), F.max("count").alias("most")).collect()  # a row for each eighth of a power of two
        self.count_kind = np.min_scalar_type(max([1, *(r["most"] for r in levels)]))
        for r in sorted(levels, key=lambda r: -r["level"]):
            seen += r["n"]
            if seen <= most:
                self.least = r["least"]
            if seen <= max(most, COMMON):
                self.least_common = r["least"]
        self.buckets = 8 * partitions(work.spark)
        self.common = work.spark.sparkContext.broadcast(self._common())  # COMMON words at most

    def _root_rows(self, which=None) -> DataFrame:
        table = self.table if which is None else self.table.where(which)
        return table.select("word", "count", "root_customers", "root_tables")

    def in_root(self, which=None) -> DataFrame:
        """(word, count, p0): every word's averaged probability in the root; which: a condition on the table's rows."""
        totals = self.totals

        def run(batches):
            for batch in batches:
                p0 = in_root(batch, totals).mean(axis=0)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p0)], ["word", "count", "p0"])

        return self._root_rows(which).mapInArrow(run, "word long, count long, p0 double")

    def _common(self) -> Common:
        if self.least_common is None:
            return Common(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        totals, kind = self.totals, self.count_kind
        pack, schema = _packed_rows(lambda x: (x.column(0).to_numpy(), x.column(1).to_numpy().astype(kind), in_root(x, totals).mean(axis=0)), "word count p0")
        found = self._root_rows(F.col("count") >= self.least_common).mapInArrow(pack, schema).toArrow()  # COMMON words at most
        word, count, p0 = (_joined(found.column(i), k) for i, k in enumerate((np.int64, kind, np.float64)))
        order = np.argsort(word)
        return Common(word[order], count[order], p0[order])

    def rare_rows(self) -> DataFrame:
        """(word, _model): the rows of words outside the head as bytes, several rows for each bucket of words; word is the bucket's key."""
        buckets, kind, samples = self.buckets, self.count_kind, len(self.totals.customers)

        def run(batches):
            for batch in _gathered(batches, 40_000):
                batch = batch.take(pa.array(np.argsort(batch.column(0).to_numpy())))
                column = lambda c: batch.column(batch.schema.get_field_index(c))
                flat = lambda c, k: column(c).flatten().to_numpy().astype(k)
                size = np.diff(column("places").offsets.to_numpy())
                bucket = bucket_of(column("word").to_numpy(), buckets)
                begin = np.flatnonzero(np.diff(bucket, prepend=-1))
                by_row = np.append(begin, len(bucket))
                by_place = np.concatenate([[0], np.cumsum(size)])[by_row]
                cut = lambda a, at: pa.array([a[i:j].tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
                made = [cut(column("word").to_numpy(), by_row), cut(column("count").to_numpy().astype(kind), by_row), cut(size.astype(np.uint16), by_row)]
                made += [cut(flat("places", np.uint16), by_place), cut(flat("counts", kind), by_place), cut(flat("tables", kind), by_place * samples)]
                made += [cut(flat(c, kind), by_row * samples) for c in ("root_customers", "root_tables")]
                yield pa.RecordBatch.from_arrays([pa.array(WORDS - bucket[begin]), pa.StructArray.from_arrays(made, _PACKED)], ["word", "_model"])

        table = self.table if self.least is None else self.table.where(F.col("count") < self.least)
        return table.mapInArrow(run, f"word long, _model struct<{', '.join(f'{c}:binary' for c in _PACKED)}>")

    def learn_rare(self, texts: DataFrame) -> None:
        """Counts what follows each rare word in texts, whose column is text."""
        own, common, buckets = self.totals.own, self.common, self.buckets

        def run(batches):
            held, size = [], 0
            for part in arrowtext.slices(batches, "text"):
                word, place, _ = tokens(part.column(0), own)
                after = np.flatnonzero(place == 1 + len(own))
                code = common.value.find(word[after])
                held.append((word[after - 1], code, word[after][code < 0]))
                size += len(after)
                if size >= TOGETHER // 2:
                    yield packed(*(np.concatenate(x) for x in zip(*held)), None, 0, buckets, BUCKETS)
                    held, size = [], 0
            if size:
                yield packed(*(np.concatenate(x) for x in zip(*held)), None, 0, buckets, BUCKETS)

        def count(key, table):
            u, ui, code, x = unpacked(table, len(common.value.word))
            width = len(common.value.word) + len(x)
            pair, n = np.unique(ui * width + code, return_counts=True)
            code, size = pair % width, np.bincount(pair // width, minlength=len(u))
            far = code >= len(common.value.word)
            blob = lambda a, kind: pa.array([a.astype(kind).tobytes()], pa.binary())
            return pa.Table.from_arrays([
                pa.array([key[0].as_py()]), blob(u, np.int64), blob(size, np.uint32), blob(np.where(far, -1, code), np.int32), blob(x[code[far] - len(common.value.word)], np.int64), blob(n, np.uint32),
                pa.array([int((n == 1).sum())]), pa.array([int((n == 2).sum())]),
            ], ["word", "u", "size", "w", "x", "n", "ones", "twos"])

        blocks = texts.mapInArrow(run, _BLOCK)
        counted = blocks.groupBy("word").applyInArrow(count, "word long, u binary, size binary, w binary, x binary, n binary, ones long, twos long")
        self.rare = self.work.write(counted, "rare", codec="lz4_raw")
        ones, twos = self.rare.agg(F.coalesce(F.sum("ones"), F.lit(0)), F.coalesce(F.sum("twos"), F.lit(0))).collect()[0]
        self.rare_discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5

    def asked_root(self) -> DataFrame:
        """(word, w, p0): what each bucket needs to know of words that are not common; word is the bucket's."""

        def run(batches):
            for batch in batches:
                for key, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    far = np.unique(np.frombuffer(x, np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(far), key)), pa.array(far)], ["bucket", "word"])

        far = self.rare.select("word", "x").mapInArrow(run, "bucket long, word long")
        known = self.in_root(None if self.least_common is None else F.col("count") < self.least_common)
        return far.join(known, "word").select(F.col("bucket").alias("word"), F.col("word").alias("w"), "p0")

    def scores(self) -> tuple[np.ndarray, Scores]:
        """The frequent words in order, and their scores in each restaurant; made in tasks."""
        totals, back = self.totals, self.totals.back()[:, :-1]
        if self.least is None:
            return np.zeros(0, np.int64), Scores(np.zeros(0, U), np.zeros(0, np.float32), np.zeros((len(back), 0)), back)

        def columns(rows):
            lists = rows.column(rows.schema.get_field_index("places"))
            size, place = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            owner = np.repeat(np.arange(rows.num_rows), size)
            there = np.zeros((rows.num_rows, wide * 64), bool)
            there[owner, place] = True
            found = probability(rows, owner, place, totals)  # a word's places rise
            return rows.column(0).to_numpy(), np.packbits(there, axis=1, bitorder="little"), np.log10(found).astype(np.float32), np.ascontiguousarray(in_root(rows, totals).T)

        wide = -(-totals.root // 64)
        pack, schema = _packed_rows(columns, "word seen value p0")
        found = self.table.where(F.col("count") >= self.least).mapInArrow(pack, schema).toArrow()  # HEAD_SCORES numbers at most
        word, seen, value, p0 = (_joined(found.column(i), k) for i, k in enumerate((np.int64, U, np.float32, np.float64)))
        order, seen = np.argsort(word), seen.reshape(-1, wide)
        size = np.bitwise_count(seen).sum(axis=1, dtype=np.int64)
        start, size = (np.cumsum(size) - size)[order], size[order]
        value = value[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(len(value))]
        return word[order], Scores(seen[order].ravel(), value, np.ascontiguousarray(p0.reshape(len(word), -1)[order].T), back)


def in_root(rows, totals: Totals) -> np.ndarray:
    """The probability in the root of rows of the model (null counts: never seen), by sample and row."""
    scale, root = totals.scale()[:, [totals.root]], totals.root
    out = np.repeat((totals.back()[:, root] * totals.uniform)[:, None], rows.num_rows, axis=1)
    seen = np.flatnonzero(rows.column(rows.schema.get_field_index("count")).is_valid().to_numpy(zero_copy_only=False))
    customers, tables = (rows.column(rows.schema.get_field_index(c)).flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in ("root_customers", "root_tables"))
    out[:, seen] += np.maximum(customers - totals.discounts[1] * tables, 0).reshape(-1, len(scale)).T * scale
    return out


def probability(rows, index: np.ndarray, place: np.ndarray, totals: Totals) -> np.ndarray:
    """The averaged probability of the words of rows[index], rows of the model (null counts: never seen), in the restaurants given."""
    lists = {f: rows.column(i) for i, f in enumerate(rows.schema.names)}
    flat = lambda c: lists[c].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = lambda c: np.diff(lists[c].offsets.to_numpy()) * lists[c].is_valid().to_numpy(zero_copy_only=False)
    d = totals.discounts[0]
    scale, back, root, n = totals.scale(), totals.back(), totals.root, rows.num_rows
    samples, p0 = len(scale), in_root(rows, totals)
    of_leaf, l_place = np.repeat(np.arange(n), size("places")), flat("places").astype(np.int64)
    in_leaf = (flat("counts")[:, None] - d * flat("tables").reshape(-1, samples)).T * scale[:, l_place]
    found = p0[:, index]
    own = place < root
    found[:, own] *= back[:, place[own]]
    if len(of_leaf):
        keys, wanted = of_leaf * (root + 1) + l_place, index * (root + 1) + place
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == wanted)
        found[:, hit] += in_leaf[:, at[hit]]
    return found.mean(axis=0)


def bucket_of(word, buckets: int):
    """The bucket of words, rising with them."""
    return ((word >> 31) * buckets) >> 32


_BLOCK = "word long, chunk long, u binary, size binary, w binary, x binary, row binary"


def packed(u: np.ndarray, code: np.ndarray, x: np.ndarray, row: np.ndarray | None, chunk: int, buckets: int, base: int) -> pa.RecordBatch:
    """What goes with words u as blocks for the buckets of u: each u and how often it is there, the numbers with it, and for numbers of -1 a word of x each."""
    order = np.argsort(u)
    at_x = (np.cumsum(code < 0) - 1)[order]
    u, code = u[order], code[order].astype(np.int32)
    bucket = bucket_of(u, buckets)
    far = np.flatnonzero(code < 0)
    x = x[at_x[far]]
    first = np.flatnonzero(np.diff(u, prepend=-1))
    size = np.diff(first, append=len(u)).astype(np.uint32)
    begin = np.flatnonzero(np.diff(bucket, prepend=-1))
    end = np.append(begin[1:], len(u))
    cut = lambda a, lo, hi: pa.array([a[i:j].tobytes() for i, j in zip(lo.tolist(), hi.tolist())], pa.binary())
    us, xs = ((np.searchsorted(a, begin), np.searchsorted(a, end)) for a in (first, far))
    rows = cut(row[order].astype(np.uint16), begin, end) if row is not None else pa.nulls(len(begin), pa.binary())
    columns = [pa.array(base - bucket[begin]), pa.array(np.full(len(begin), chunk)), cut(u[first], *us), cut(size, *us), cut(code, begin, end), cut(x, *xs), rows]
    return pa.RecordBatch.from_arrays(columns, ["word", "chunk", "u", "size", "w", "x", "row"])


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def unpacked(blocks, common: int, u: np.ndarray | None = None, x: np.ndarray | None = None):
    """Restaurants in order, the number of each word's restaurant, each word's number, and the words that are not common, whose numbers follow the common ones.

    With u and x given, numbers are among these; restaurants not there have number -1, words the last number.
    """
    column = lambda c, kind: _joined(blocks.column(blocks.schema.get_field_index(c)), kind)
    names, size, code, far = column("u", np.int64), column("size", np.uint32), column("w", np.int32).astype(np.int64), column("x", np.int64)
    if u is None:
        u, ui = np.unique(names, return_inverse=True)
        x, xi = np.unique(far, return_inverse=True)
    else:
        ui, xi = ((np.minimum(np.searchsorted(a, b), max(len(a) - 1, 0)), a, b) for a, b in ((u, names), (x, far)))
        ui, xi = (np.where(a[i] == b, i, miss) if len(a) else np.full(len(b), miss) for (i, a, b), miss in ((ui, -1), (xi, len(x))))
    code[code < 0] = common + xi
    return u, np.repeat(ui, size), code, x


def restaurants(ui: np.ndarray, customers: np.ndarray, n: np.ndarray, word: np.ndarray, u: np.ndarray, p0: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """The parent's weight in each restaurant, and what its own tables give each word; both averaged over seatings.

    ui: the restaurant of each pair of restaurant and word, u its hash, n the pair's customers, p0 the word's probability in the root.
    """
    more = np.flatnonzero(n > 1)
    single = np.bincount(ui[n == 1], minlength=len(customers))
    given = Parent(*np.zeros((2, len(more)), np.int64), 0.0, np.zeros(len(more)), p0[more])
    t, now, total = np.ones(len(more), np.int64), None, np.zeros(len(more))
    for sweep in range(SETTLE + SAMPLES):
        seats = single + np.bincount(ui[more], t, len(customers))
        now = sweep_once(now, n[more], given, seats[ui[more]] - t, discount, word[more], u[more], sweep)
        t = now.tables()
        if sweep >= SETTLE:
            total += t / SAMPLES
    tables = np.ones(len(n))
    tables[more] = total
    back = (STRENGTH + discount * np.bincount(ui, tables, len(customers))) / (STRENGTH + customers)
    return back, (n - discount * tables) / (STRENGTH + customers[ui])


class Bucket:
    """The restaurants of rare words in a bucket: rows of the model's rare table, and (w, p0) of the words that are not common."""

    def __init__(self, rare, w: np.ndarray, p0: np.ndarray, common: Common, discount: float):
        self.common = common
        self.u, ui, code, self.x = unpacked(rare, len(common.word))
        self.width = len(common.word) + len(self.x) + 1
        n = _joined(rare.column(rare.schema.get_field_index("n")), np.uint32).astype(np.int64)
        customers = np.bincount(ui, n, len(self.u))
        order = np.argsort(w)
        names, of_root = np.concatenate([common.word, self.x]), np.concatenate([common.p0, p0[order][np.searchsorted(w[order], self.x)]])
        self.back, own = restaurants(ui, customers, n, names[code], self.u[ui], of_root[code], discount)
        self.key, value = ui * self.width + code, np.log10(self.back[ui] + own / of_root[code])
        order = np.argsort(self.key)
        self.key, self.value = self.key[order], value[order]
        self.log_back = np.append(np.log10(self.back), 0.0)  # an empty restaurant asks the root, and is the last

    def asked(self, blocks) -> np.ndarray:
        """log10 of the words' probability after their rare words over that in the root."""
        _, ui, code, _ = unpacked(blocks, len(self.common.word), self.u, self.x)
        out, key = self.log_back[ui], ui * self.width + code
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = np.flatnonzero(self.key[at] == key)
            out[hit] = self.value[at[hit]]
        return out


class Sums:
    """known, base and score to be added to the rows of chunks of texts."""

    def __init__(self):
        self.chunks, self.size = {}, 0

    def add(self, chunk: int, row: np.ndarray, *values) -> None:
        have, need = self.chunks.get(chunk), int(row.max()) + 1
        if have is None or have.shape[1] < need:
            self.size += need - (0 if have is None else have.shape[1])
            self.chunks[chunk] = have = np.zeros((3, need)) if have is None else np.pad(have, ((0, 0), (0, need - have.shape[1])))
        for i, v in enumerate(values):
            if v is not None:
                have[i, :need] += np.bincount(row, v, need)

    def flush(self, schema):
        """A row for each chunk."""
        blob = lambda i, kind: pa.array([x[i].astype(kind).tobytes() for x in self.chunks.values()], pa.binary())
        n, made = len(self.chunks), {"_chunk": pa.array(list(self.chunks), pa.int64()), "_knowns": blob(0, np.int32), "_bases": blob(1, np.float64), "_scores": blob(2, np.float32)}
        self.__init__()
        return pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(n, f.type) for f in schema], schema=schema)


def train(texts: DataFrame, text: str = "text") -> Model:
    """A model of all rows of texts."""
    work, n = Workspace(texts.sparkSession, "language-model"), partitions(texts.sparkSession)
    texts = texts.select(F.col(text).alias("text"))
    counts = work.write(_counted(texts, None).groupBy("word").agg(F.sum("n").alias("n")), "counts")
    tokens_ = counts.agg(F.sum("n")).collect()[0][0] or 0
    frequent = counts.where((F.col("n") * OWN_SHARE >= tokens_) & (F.col("word") != END)).select("word").collect()  # OWN_SHARE at most
    own = np.array(sorted(r[0] for r in frequent), np.int64)
    pairs = _counted(texts, own).repartition(n, "word").groupBy("word", "place").agg(F.sum("n").alias("n"))
    words = pairs.groupBy("word").agg(F.collect_list(F.struct("place", "n")).alias("seen"))  # an entry for each restaurant
    words = work.write(words.select("word", F.col("seen.place").alias("places"), F.col("seen.n").alias("counts")), "words")
    totals = _summed(work.write(_seated(words, None, own).where("word is null"), "before"), own)
    for i in range(PASSES - 1):
        discounts, words_ = totals.discounts, totals.words
        totals = _summed(work.write(_seated(words, totals, own, brief=True).where("word is null"), f"pass-{i}"), own)
        totals.discounts = discounts
    model = work.write(_seated(words, totals, own), "model")
    final = _summed(model, own)
    final.discounts = totals.discounts
    learned = Model(work, model.where("word is not null").drop("place", "sums", "table_sums"), final, int(tokens_))
    learned.learn_rare(texts)
    return learned


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """keep, n_tokens, n_known, train_tokens, base_score and score of each row of docs."""
    spark, totals, n_tokens, discount = docs.sparkSession, model.totals, model.tokens, model.rare_discount
    head = spark.sparkContext.broadcast((*model.scores(), totals))  # HEAD_SCORES numbers at most
    common, buckets, kind = model.common, model.buckets, model.count_kind
    inner = [f"_kept_{i}" for i in range(len(keep))]
    docs = docs.select(F.col(text).alias("_text"), *(F.col(f"`{k}`").alias(i) for k, i in zip(keep, inner)))
    own_ddl = "".join(f"{x}, " for x in [ddl(docs.select(*inner))] if inner)
    doc_ddl = f"struct<{own_ddl.replace('` ', '`:')}tokens:long,known:long,base:double,score:double>"
    asked = f"word long, _row long, _doc {doc_ddl}, _block struct<chunk:long,u:binary,size:binary,w:binary,x:binary,row:binary>"

    def run(batches):
        from pyspark import TaskContext

        word_of, scores, totals = head.value
        own = totals.own
        root, everyday = 1 + len(own), common.value
        dense = np.full(len(everyday.word) + 1, -1)
        dense[everyday.find(word_of)] = np.arange(len(word_of))
        dense[-1] = -1
        plain, of_root = (np.append(x, 0.0) for x in (np.log10((everyday.count + 1.0) / (n_tokens + totals.words + 1)), np.log10(everyday.p0)))
        chunk, rows, size = TaskContext.get().partitionId() << 24, 0, 0
        held = {BUCKETS: [], WORDS: []}
        doc_type = None

        def blocks():
            for base, parts in held.items():
                if parts:
                    made = packed(*(np.concatenate(x) for x in zip(*parts)), chunk, buckets, base)
                    block = pa.StructArray.from_arrays(made.columns[1:], made.schema.names[1:])
                    yield pa.RecordBatch.from_arrays([made.column(0), pa.nulls(len(block), pa.int64()), pa.nulls(len(block), doc_type), block], _ASKED)

        for part in arrowtext.slices(batches, "_text"):
            word, place, row = tokens(part.column(0), own)
            if rows and rows + part.num_rows > CHUNK_ROWS or size >= TOGETHER // 2:
                yield from blocks()
                chunk, rows, size = chunk + 1, 0, 0
                held = {BUCKETS: [], WORDS: []}
            code = everyday.find(word)
            at_head = dense[code]
            is_head, after = at_head >= 0, np.flatnonzero(place == root)
            answered = is_head.copy()
            answered[after] = code[after] >= 0
            count = part.num_rows
            known = np.bincount(row[answered], minlength=count)
            base = np.bincount(row, np.where(answered, plain[code], 0.0), count)
            values = np.zeros(len(word))
            at = np.flatnonzero(is_head & (place != root))
            if len(at):
                values[at] = scores(at_head[at], place[at])
            values[after] = of_root[code[after]]
            found = np.bincount(row, values, count)
            at = (rows + row).astype(np.uint16)
            if len(after):
                held[BUCKETS].append((word[after - 1], code[after], word[after][code[after] < 0], at[after]))
            if len(rare := np.flatnonzero(~answered)):
                held[WORDS].append((word[rare], place[rare], word[:0], at[rare]))
            size += len(after) + len(rare)
            ids = (chunk << 16) + rows + np.arange(count)
            rows += count
            kept = [part.column(1 + i) for i in range(len(inner))]
            doc = pa.StructArray.from_arrays([*kept, pa.array(np.bincount(row, minlength=count)), pa.array(known), pa.array(base), pa.array(found)], [*inner, "tokens", "known", "base", "score"])
            doc_type = doc.type
            yield pa.RecordBatch.from_arrays([pa.array(-1 - ids), pa.array(ids), doc, pa.nulls(count, _BLOCK_TYPE)], _ASKED)
        yield from blocks()

    def finish(batches):
        totals, sums = head.value[2], Sums()
        rest = math.log10(n_tokens + totals.words + 1)

        def add(asks, *values):
            at = 0
            for chunk, row in zip(asks.column(0).to_pylist(), asks.column(asks.schema.get_field_index("row")).to_pylist()):
                row = np.frombuffer(row, np.uint16)
                sums.add(chunk, row, *(v if v is None else v[at : at + len(row)] for v in values))
                at += len(row)

        def meet(key, parts):
            """What is asked of a bucket meets what it has of the model."""
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            column = lambda c: whole.column(whole.schema.get_field_index(c))
            there = lambda c: column(c).is_valid().to_numpy(zero_copy_only=False)
            pick = lambda c: pa.RecordBatch.from_struct_array(column(c).filter(pa.array(there(c))))
            asks = pick("_block")
            if not asks.num_rows:
                return
            if key <= BUCKETS:
                of_root = pick("_root")
                of = Bucket(pick("_rare"), of_root.column(0).to_numpy(), of_root.column(1).to_numpy(), common.value, discount)
                for lo in range(0, asks.num_rows, 32):
                    some = asks.slice(lo, 32)
                    add(some, None, None, of.asked(some))
                return
            names, counts, model_rows = _unpacked_rows(pick("_model"), kind)  # the last is a word never seen
            order = np.argsort(names)
            names, order = names[order], np.append(order, len(order))
            for lo in range(0, asks.num_rows, 256):
                some = asks.slice(lo, 256)
                _, at, place, _ = unpacked(some, 0, names, names[:0])
                index = order[at]
                count = counts[index]
                add(some, count > 0, np.log10(count + 1) - rest, np.log10(probability(model_rows, index, place, totals)))

        held, bucket, schema = [], None, None
        for batch in batches:
            if schema is None:
                schema = pa.schema([("_chunk", pa.int64()), ("_at", pa.int32()), ("_doc", batch.schema.field("_doc").type), *((c, pa.binary()) for c in ("_knowns", "_bases", "_scores"))])
            key = batch.column(0).to_numpy()
            first = int(np.searchsorted(key, WORDS, side="right"))
            cuts = [0, *(np.flatnonzero(np.diff(key[:first])) + 1).tolist(), first] if first else []
            for lo, hi in zip(cuts, cuts[1:]):
                if held and key[lo] != bucket:
                    meet(bucket, held)
                    held = []
                    if sums.size > TOGETHER:
                        yield sums.flush(schema)
                held.append(batch.slice(lo, hi - lo))
                bucket = int(key[lo])
            if first < batch.num_rows:
                docs_ = batch.slice(first)
                row = docs_.column(1).to_numpy()
                made = [pa.array(row >> 16), pa.array((row & 65535).astype(np.int32)), docs_.column(docs_.schema.get_field_index("_doc"))]
                yield pa.RecordBatch.from_arrays([*made, *(pa.nulls(len(row), pa.binary()) for _ in range(3))], schema=schema)
        if held:
            meet(bucket, held)
        if sums.chunks:
            yield sums.flush(schema)

    def whole(table):
        """The rows of a chunk, with all that was found of them."""
        is_doc = table.column("_at").combine_chunks().is_valid()
        own, more = table.filter(is_doc), table.filter(pa.array(~is_doc.to_numpy(zero_copy_only=False)))
        at, doc = own.column("_at").to_numpy(), pa.RecordBatch.from_struct_array(own.column("_doc").combine_chunks())
        added = np.zeros((3, int(at.max(initial=0)) + 1))
        for i, (c, kind) in enumerate((("_knowns", np.int32), ("_bases", np.float64), ("_scores", np.float32))):
            for blob in more.column(c).to_pylist():
                x = np.frombuffer(blob, kind)
                added[i, : len(x)] += x
        n, known, base, found = (doc.column(len(inner) + i).to_numpy() for i in range(4))
        columns = [*doc.columns[: len(inner)], pa.array(n), pa.array(known + np.rint(added[0, at]).astype(np.int64)), pa.array(base + added[1, at]), pa.array(found + added[2, at])]
        return pa.Table.from_arrays(columns, [*inner, "n_tokens", "n_known", "base_score", "score"])

    parts = docs.mapInArrow(run, asked)
    rare = model.rare.select("word", F.struct("u", "size", "w", "x", "n").alias("_rare"))
    of_root = model.asked_root().select("word", F.struct("w", "p0").alias("_root"))
    both = parts
    for other in (model.rare_rows(), rare, of_root):
        both = both.unionByName(other, allowMissingColumns=True)
    # the model's rows and what is asked of them meet by the bucket, as bytes; no row of the model is copied
    met = both.repartition(partitions(spark), "word").sortWithinPartitions("word")
    done = met.mapInArrow(finish, f"_chunk long, _at int, _doc {doc_ddl}, _knowns binary, _bases binary, _scores binary")
    summed = done.groupBy("_chunk").applyInArrow(whole, f"{own_ddl}n_tokens long, n_known long, base_score double, score double")
    summed = summed.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return summed.select(*(F.col(i).alias(k) for i, k in zip(inner, keep) if k.lower() not in made), *made)


_ASKED = ["word", "_row", "_doc", "_block"]
_BLOCK_TYPE = pa.struct([("chunk", pa.int64()), *((c, pa.binary()) for c in ("u", "size", "w", "x", "row"))])


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity by token of the model and of the base, in one row."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.agg(per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))
