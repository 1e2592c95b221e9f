"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text finds the longest match from any place of a new text.
Parsing the text into such matches gives phrases; a language's own text needs few. The count is divided by
what the language's own held-back text needs, and the language with the fewest normalised phrases wins.

Whole texts are parsed. Pieces of PIECE code points run side by side as lanes of numpy arrays and are joined up
afterwards, which gives the parse of the whole text.

Defined cases: text that is null or has no letter is ``und`` with score 0, as is every text when nothing was
learned. Ties go to the first language by name, with score 0. Rows without id or lang teach nothing. Of more than
MAX_LANGUAGES labels those with the most rows are learned, of equally frequent ones the first by name.
Repeated rows give repeated rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlprism.llm.common import kept, map_batches

# The bounded sample a language is learned from: so many texts, so many code points of each, and in all
# so many for the automaton and for the normalising rate.
SAMPLE_TEXTS = 128
SAMPLE_CHARS = 2048
AUTOMATON_CHARS = 16_384
RATE_CHARS = 8_192

# So many labels are learned at most: with the two bounds above, this is what limits the sample on the driver.
MAX_LANGUAGES = 200

PIECE = 1024
LANES = 4096
TRACE = 128
# Up to this many lanes are walked one by one, which is faster than arrays of so few.
FEW = 64
GOLDEN = 0x9E3779B97F4A7C15

UNKNOWN, SPACE, END = 0, 1, 2


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points, with one space for every run of anything but letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, points, 32)[keep]


class Automaton:
    """A suffix automaton of symbols. State 1 is the empty match, 0 stands for no match.

    Edges are kept in a hash table of (state, symbol), at most half full, so memory goes with what was learned and not with how
    many characters all languages have between them.
    """

    def __init__(self, symbols: list[int], n_symbols: int):
        step: list[dict[int, int]] = [{}, {}]
        link, length, last = [0, 0], [0, 0], 1
        for c in symbols:
            new = len(step)
            step.append({})
            link.append(1)
            length.append(length[last] + 1)
            p = last
            while p and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    clone = len(step)
                    step.append(dict(step[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
        self.width = n_symbols
        self.root = np.zeros(n_symbols, np.int32)
        for c, to in step[1].items():
            self.root[c] = to
        # no text holds END, so its edges are never taken
        edges = [(state * n_symbols + c, to) for state, row in enumerate(step) for c, to in row.items() if c != END]
        self._store(np.array([k for k, _ in edges], np.int64), np.array([to for _, to in edges], np.int32))

    def _store(self, keys: np.ndarray, to: np.ndarray) -> None:
        bits = max(int(2 * len(keys)).bit_length(), 4)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        slot = self._slots(keys)
        while len(keys):
            # of the edges that ask for a free slot the first takes it, the others go on to the next slot
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            takes = first & (self.keys[slot] < 0)
            self.keys[slot[takes]], self.to[slot[takes]] = keys[takes], to[takes]
            keys, to, slot = keys[~takes], to[~takes], (slot[~takes] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(GOLDEN)) >> self.shift).astype(np.int64)

    @property
    def n_bytes(self) -> int:
        return self.keys.nbytes + self.to.nbytes + self.root.nbytes

    def follow(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states after one more symbol, 0 where the match cannot be prolonged."""
        key = state * np.int64(self.width) + c
        slot = self._slots(key)
        held = self.keys[slot]
        hit = held == key
        out = np.where(hit, self.to[slot], 0)
        left = np.flatnonzero(~hit & (held >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            held = self.keys[slot[left]]
            hit = held == key[left]
            out[left[hit]] = self.to[slot[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out

    def parse(self, lanes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where phrases begin in each lane (time, lane), the states of the first TRACE steps, and the state each lane ends in.

        The lanes come in descending order of length. Each starts with a new phrase. An unknown symbol is a phrase by itself.
        """
        state = np.zeros(lanes.shape[1], np.int32)
        begins = np.zeros(lanes.shape, bool)
        trace = np.zeros((min(TRACE, lanes.shape[0]), lanes.shape[1]), np.int32)
        alive = np.searchsorted(-lengths, -np.arange(lanes.shape[0]), side="left")
        for t in range(lanes.shape[0]):
            k = alive[t]
            c = lanes[t, :k]
            to = self.follow(state[:k], c)
            broken = to == 0
            begins[t, :k] = broken
            state[:k] = np.where(broken, self.root[c], to)
            if t < TRACE:
                trace[t, :k] = state[:k]
        return begins, trace, state

    def resume(
        self, lanes: np.ndarray, lengths: np.ndarray, begins: np.ndarray, trace: np.ndarray, which: np.ndarray, state: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Parse the lanes ``which`` anew from ``state``, up to where the old parse is in the same state or begins a phrase as well:
        from there on both agree.

        ``begins`` and ``trace`` are corrected in place. Returns the lanes that never met their old parse, and their last states.
        """
        ends, last = [], []
        for t in range(lanes.shape[0]):
            over = lengths[which] == t
            if over.any():
                ends.append(which[over])
                last.append(state[over])
                which, state = which[~over], state[~over]
            if len(which) <= FEW:
                break
            c = lanes[t, which]
            to = self.follow(state, c)
            broken = to == 0
            state = np.where(broken, self.root[c], to)
            apart = ~(broken & begins[t, which])
            begins[t, which] = broken
            if t < TRACE:
                apart &= state != trace[t, which]
                trace[t, which] = state
            which, state = which[apart], state[apart]
        else:
            t = lanes.shape[0]
        for lane, one in zip(which.tolist(), state.tolist()):
            end = self._walk(lanes[: lengths[lane], lane], begins[:, lane], trace[:, lane], t, one)
            if end is not None:
                ends.append([lane])
                last.append([end])
        return np.concatenate([*ends, []]).astype(np.int64), np.concatenate([*last, []]).astype(np.int32)

    def _walk(self, lane: np.ndarray, begins: np.ndarray, trace: np.ndarray, start: int, state: int) -> int | None:
        """The same for one lane from ``start``, symbol by symbol: its last state, or None where it met the old parse."""
        keys, targets, root = memoryview(self.keys), memoryview(self.to), memoryview(self.root)
        shift, mask, width = int(self.shift), self.mask, self.width
        old, held = begins.tolist(), trace.tolist()
        for t, c in enumerate(lane[start:].tolist(), start):
            key = state * width + c
            slot = (key * GOLDEN & 0xFFFFFFFFFFFFFFFF) >> shift
            while keys[slot] != key and keys[slot] >= 0:
                slot = (slot + 1) & mask
            broken = keys[slot] < 0
            state = root[c] if broken else targets[slot]
            met = broken and old[t] or t < len(held) and held[t] == state
            begins[t] = broken
            if t < len(held):
                trace[t] = state
            if met:
                return None
        return state


class Lanes:
    """Texts cut into pieces that are parsed side by side, and then joined up so that each text is parsed as a whole."""

    def __init__(self, texts: list[np.ndarray], piece: int = PIECE, lanes: int = LANES):
        pieces, owner, follows = [], [], []
        for i, t in enumerate(texts):
            for at in range(0, len(t), piece):
                pieces.append(t[at : at + piece])
                owner.append(i)
                follows.append(at > 0)
        order = np.array(sorted(range(len(pieces)), key=lambda i: -len(pieces[i])), np.int64)
        self.n_texts, self.lanes = len(texts), lanes
        self.owner = np.array(owner, np.int64)[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # by place: the lane that goes on with the same text, or -1
        self.next = np.full(len(order), -1, np.int64)
        later = np.flatnonzero(np.array(follows, bool))
        self.next[place[later - 1]] = place[later]
        self.grids = []
        for at in range(0, len(order), lanes):
            part = [pieces[i] for i in order[at : at + lanes]]
            lengths = np.array([len(p) for p in part])
            grid = np.zeros((lengths.max(), len(part)), part[0].dtype)
            for i, p in enumerate(part):
                grid[: len(p), i] = p
            self.grids.append((grid, lengths))

    def phrases(self, automaton: Automaton) -> np.ndarray:
        """Phrases of each whole text.

        Parses that begin at different places soon come into the same state or begin a phrase at the same place, so joining a piece to
        the one before takes few steps. A piece whose end changes by it hands that on to the next one; at worst a text is parsed in sequence.
        """
        parts = [automaton.parse(grid, lengths) for grid, lengths in self.grids]
        count = np.zeros(self.n_texts, np.int64)
        if not parts:
            return count
        state = np.concatenate([end for _, _, end in parts])
        from_lane = np.flatnonzero(self.next >= 0)
        while len(from_lane):
            to_lane, carried = self.next[from_lane], state[from_lane]
            changed = []
            for k in np.unique(to_lane // self.lanes).tolist():
                mine = to_lane // self.lanes == k
                grid, lengths = self.grids[k]
                apart, last = automaton.resume(grid, lengths, *parts[k][:2], to_lane[mine] - k * self.lanes, carried[mine])
                apart += k * self.lanes
                other = state[apart] != last
                state[apart[other]] = last[other]
                changed.append(apart[other])
            from_lane = np.concatenate(changed)
            from_lane = from_lane[self.next[from_lane] >= 0]
        for k, (begins, _, _) in enumerate(parts):
            np.add.at(count, self.owner[k * self.lanes : k * self.lanes + begins.shape[1]], begins.sum(axis=0))
        return count


def lesson(texts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """What of a language's texts is learned, what is held back for the rate, and how many texts that took."""
    learn, check, n_learn, n_check, taken = [], [], 0, 0, 0
    for i, t in enumerate(texts):
        if n_learn >= AUTOMATON_CHARS and n_check >= RATE_CHARS:
            break
        taken = i + 1
        # every fifth text is held back
        if i % 5 == 4 and n_check < RATE_CHARS:
            check.append(t)
            n_check += len(t)
        elif n_learn < AUTOMATON_CHARS:
            learn.append(t[: AUTOMATON_CHARS - n_learn])
            n_learn += len(learn[-1])
    return learn, check, taken


class Model:
    """Automata and rates of all languages, from {language: [texts]}."""

    def __init__(self, sample: dict[str, list[str]]):
        texts = {lang: [code_points(t) for t in rows] for lang, rows in sorted(sample.items())}
        texts = {lang: [t for t in rows if len(t)] for lang, rows in texts.items()}
        texts = {lang: rows for lang, rows in texts.items() if rows}
        self.languages = list(texts)
        lessons = {lang: lesson(rows) for lang, rows in texts.items()}
        alphabet = sorted({c for learn, _, _ in lessons.values() for t in learn for c in np.unique(t).tolist()} - {32})
        self.width = END + 1 + len(alphabet)
        self.symbol = np.zeros(0x110000, np.uint16 if self.width < 1 << 16 else np.uint32)
        self.symbol[32] = SPACE
        self.symbol[alphabet] = np.arange(END + 1, self.width)
        self.automata, rates = [], []
        for learn, check, _ in lessons.values():
            automaton = Automaton([c for t in learn for c in [*self.symbol[t].tolist(), END]], self.width)
            self.automata.append(automaton)
            n_check = sum(len(t) for t in check)
            rates.append(Lanes([self.symbol[t] for t in check]).phrases(automaton).sum() / n_check if n_check else np.nan)
        rates = np.array(rates)
        known = rates[np.isfinite(rates)]
        self.rates = np.where(np.isfinite(rates), rates, known.mean() if len(known) else 1.0)

    def normalised(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases per code point over the language's own rate: (text, language)."""
        lanes = Lanes([self.symbol[t] for t in texts])
        count = np.stack([lanes.phrases(automaton) for automaton in self.automata], axis=1)
        sizes = np.array([max(len(t), 1) for t in texts])
        return count / sizes[:, None] / self.rates[None, :]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return langs, scores
        points = [code_points(t) if t else np.zeros(0, np.uint32) for t in texts]
        rows = [i for i, p in enumerate(points) if len(p)]
        if not rows:
            return langs, scores
        need = self.normalised([points[i] for i in rows])
        best = need.argmin(axis=1)
        ranked = np.sort(need, axis=1)
        for j, i in enumerate(rows):
            langs[i] = self.languages[best[j]]
            # how far the runner-up is behind; a lone language is scored by its own rate
            scores[i] = float(1 - ranked[j, 0] / ranked[j, 1]) if len(self.languages) > 1 else float(min(1.0, 1 / ranked[j, 0]))
        return langs, scores


def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def training_sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES
) -> dict[str, list[str]]:
    """A bounded sample of the rows that may be learned from: per language the SAMPLE_TEXTS first by a hash of the id.

    The labels with the most rows are learned, up to ``max_languages``; counting them reads no text. Ids and languages alone are
    ranked; each task keeps its first ones before anything is shuffled.
    """
    common = (
        docs.where(F.col(lang_col).isNotNull() & (fold(id_col) != 2))
        .groupBy(F.col(lang_col).alias("lang"))
        .count()
        .orderBy(F.desc("count"), "lang")
        .limit(max_languages)
    )
    languages = [row["lang"] for row in common.collect()]
    labelled = docs.where(F.col(lang_col).isin(languages)).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col) != 2))
    order = Window.partitionBy("lang").orderBy("h", "id")
    chosen = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("h"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= SAMPLE_TEXTS)
        .select("lang", "id", "h")
        .distinct()
    )
    side = F.broadcast(chosen)  # SAMPLE_TEXTS ids for each of max_languages labels at most
    texts = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.substring(text_col, 1, SAMPLE_CHARS).alias("text"))
        .join(side, ["lang", "id"])
        .groupBy("lang", "h", "id")
        .agg(F.min("text").alias("text"))
        .orderBy("lang", "h", "id")
        .collect()  # SAMPLE_TEXTS * SAMPLE_CHARS code points for each language at most
    )
    sample: dict[str, list[str]] = {}
    for row in texts:
        sample.setdefault(row["lang"], []).append(row["text"])
    return {lang: _used(rows) for lang, rows in sample.items()}


def _used(texts: list[str]) -> list[str]:
    """The first texts, as many as the model takes: only these are sent to the workers."""
    with_letters = [t for t in texts if len(code_points(t))]
    return with_letters[: lesson([code_points(t) for t in with_letters])[2]]


def _model(shared, key: str) -> Model:
    """Built once in each worker from the broadcast sample."""
    return kept(("language", key), lambda: Model(shared.value))


def share(docs: DataFrame, sample: dict[str, list[str]]):
    return docs.sparkSession.sparkContext.broadcast(sample), hashlib.md5(repr(sorted(sample.items())).encode()).hexdigest()


def predictions(docs: DataFrame, sample: dict[str, list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its text alone. No shuffle."""
    shared, key = share(docs, sample)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = _model(shared, key).predict(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, sample: dict[str, list[str]], text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose text is in some language that was learned; if none was, those whose text has a letter."""
    shared, key = share(docs, sample)
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, model = batch.column(place).to_pylist(), _model(shared, key)
        if model.languages:
            found = [lang != "und" for lang in model.predict(texts)[0]]
        else:
            found = [bool(t) and len(code_points(t)) > 0 for t in texts]
        return batch.filter(pa.array(found, pa.bool_()))

    return map_batches(docs, run, docs.schema)


def digest(docs: DataFrame, found: DataFrame) -> DataFrame:
    held_out = F.coalesce(fold("doc_id") == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
