"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.

Ordinary text has one first-order chain over characters.  Its transition counts are a small
table that adds up, so they are taken over all documents, from the long words that no pattern
covers, and from labelled identifiers and paths.  Random strings are a mixture of chains: one
for each usual alphabet, and one counted from the values that the patterns find.  A word that
no pattern covers is reported when its log-likelihood ratio in all reaches a threshold, so a
longer word needs less per character.  The threshold is learned: labelled ordinary words of a
vocabulary that training does not see reach it at a rate of at most ``FALSE_ALARMS``.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.llm.common import tidy, values


# The base patterns and the lengths below which a match is dropped.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "markov")
# End of the fixed values.

#: Words that the models judge and learn from; shorter ones hold too little to tell.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
#: Share of the held-out ordinary words that may reach the threshold, and labelled words of each half.
FALSE_ALARMS, SAMPLES = 0.002, 6000

# Words of usual identifiers, paths and file names, and alphabets of random strings.
VOCABULARY = (
    "account action active address admin agent alert archive article assets async backup balance batch binary branch buffer "
    "build button cache calendar callback category channel client cluster column command comment commit common company config "
    "connection content context controller counter country create current customer database date default delete deploy detail "
    "device document domain download driver email enable encoder engine entity entry error event example exception export "
    "factory feature fetch field file filter folder footer format function gateway general group handler header height helper "
    "history home host image import include index input install instance integer interface internal invoice item job language "
    "layout length library license list loader local location logger manager mapping master memory message method metric mobile "
    "model module monitor month network node notice number object offset online option order output package page parameter "
    "parser partner password path payment pending person picture platform player plugin policy position prefix price print "
    "private process product profile project property provider public query queue random reader record region register release "
    "remote report request resource response result role route schema screen script search section security segment select "
    "sequence server service session setting shared shipping signal single snapshot source special standard start state static "
    "status storage store stream string style submit summary support switch symbol system table target task team template "
    "terminal test text thread ticket time title token total track transaction transfer trigger type unique update upload "
    "user value vendor version video view virtual visible warning web widget width window worker wrapper writer year zone").split()
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_-")
# End of the fixed values.


def ordinary_words(half: int, n: int = SAMPLES) -> list[str]:
    """Labelled ordinary words of 12 characters or more: identifiers with and without digits, paths, numbers and rules.

    Their parts are every second word of the vocabulary, from ``half`` (0: for training, 1: held out).
    """
    rng, known, made = random.Random(half), VOCABULARY[half::2], []
    while len(made) < n:
        parts = rng.choices(known, k=rng.randint(2, 5))
        digits = rng.choice(["", "", str(rng.randrange(10)), str(rng.randrange(1000)), f"{rng.randint(1990, 2030)}", f"v{rng.randrange(10)}"])
        if digits:
            parts.insert(rng.randint(1, len(parts)), digits)
        shape = rng.randrange(9)
        if shape == 0:
            word = "_".join(parts)
        elif shape == 1:
            word = "-".join(parts)
        elif shape == 2:
            word = "_".join(parts).upper()
        elif shape == 3:
            word = "".join(p.upper() if rng.random() < 0.1 else p.capitalize() for p in parts)
        elif shape == 4:
            word = parts[0] + "".join(p.capitalize() for p in parts[1:])
        elif shape == 5:
            word = "/" * rng.randrange(2) + "/".join(p.capitalize() if rng.random() < 0.1 else p for p in parts)
        elif shape == 6:
            word = "".join(rng.choices("0123456789", k=rng.randint(12, 20)))
        elif shape == 7:
            word = rng.choice(_ALPHABET[:-1]) * rng.randint(12, 40)
        else:
            word = f"/{parts[0]}/{rng.randint(1990, 2030)}/{rng.randint(1, 12):02d}/" + "-".join(parts[1:])
        if len(word) >= 12:
            made.append(word)
    return made


_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
STATES = len(_ALPHABET) + 1  # the last one is the start
_CODE = np.full(128, len(_ALPHABET), np.int64)
_CODE[[ord(c) for c in _ALPHABET]] = np.arange(len(_ALPHABET))
_HEX24 = re.compile(r"[0-9a-f]{24,}")
_ACCESS20 = re.compile(r"AKIA[A-Z0-9]{16,}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then in the order of the kinds."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]] if (
        ":" in text or "=" in text) else []
    # a run that is long enough is the same match with its least length in the pattern
    found += [(m.start(), m.end(), "access") for m in _ACCESS20.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX24.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _codes(word: str) -> np.ndarray:
    return _CODE[np.frombuffer(word.encode("ascii"), np.uint8)]


def _values(text: str, spans):
    """The random-string samples of a text."""
    for start, end, kind in spans:
        if kind == "assign":
            yield ASSIGN.match(text, start, end)[2]
        else:
            yield text[start:end]


def _train(batches):
    """Transition counts of both classes, one row per transition that occurs in this task."""
    counts = np.zeros((2, STATES, STATES), np.int64)
    tally = Counter()
    for batch in batches:
        for text in values(batch.column(0)):
            if not text:
                continue
            spans = base_spans(text)
            for value in _values(text, spans):
                _add(counts[0], value)
            for start, word in _free(text, spans):
                tally[word] += 1
        if len(tally) >= 200_000:
            _add_all(counts[1], tally)
    _add_all(counts[1], tally)
    label, before, after = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(x.astype(np.int32)) for x in (label, before, after)] + [pa.array(counts[label, before, after])],
        ["label", "before", "after", "n"])


def _free(text, base):
    """(start, word) of the candidates that overlap no base span."""
    for m in CANDIDATE.finditer(text):
        if all(m.end() <= s or m.start() >= e for s, e, _ in base):
            yield m.start(), m[0]


def _add(counts, word, times=1):
    codes = np.concatenate([[STATES - 1], _codes(word)])
    np.add.at(counts, (codes[:-1], codes[1:]), times)


def _add_all(counts, tally):
    for word, times in tally.items():
        _add(counts, word, times)
    tally.clear()


def _shares(counts):
    """Chances of each next character; what was not seen gets the chance of the character by itself."""
    single = (counts.sum(0) + 1.0) / (counts.sum() + STATES)
    return (counts + 5.0 * single) / (counts.sum(1, keepdims=True) + 5.0)


class Models:
    """Log-likelihood ratio of random strings over ordinary words, and its learned threshold."""

    def __init__(self, counts: np.ndarray):
        # labelled words and those of the documents tell alike, however many documents there are
        labelled = np.zeros((STATES, STATES), np.int64)
        for word in ordinary_words(0):
            _add(labelled, word)
        met = counts[1] * min(1.0, labelled.sum() / max(counts[1].sum(), 1))
        ordinary = np.log(_shares(labelled + met))
        chains = []
        for letters in ALPHABETS:
            chain = np.full((STATES, STATES), -np.inf)
            chain[:, _codes(letters)] = -np.log(len(letters))
            chains.append(chain)
        # values found may be few: half of their chain is the chance of any letter or digit
        chains.append(np.log(0.5 * _shares(counts[0]) + 0.5 / (STATES - 1)))
        self.ratios = [chain - ordinary for chain in chains]
        self.known: dict[str, bool] = {}
        scores = np.sort([self.score(w) for w in ordinary_words(1)])
        self.threshold = float(scores[int(np.ceil(len(scores) * (1 - FALSE_ALARMS))) - 1])

    def score(self, word: str) -> float:
        codes = np.concatenate([[STATES - 1], _codes(word)])
        sums = [float(ratio[codes[:-1], codes[1:]].sum()) for ratio in self.ratios]
        return float(np.logaddexp.reduce(sums)) - float(np.log(len(sums)))

    def random(self, word: str) -> bool:
        if word not in self.known:
            if len(self.known) >= 100_000:
                self.known.clear()
            self.known[word] = self.score(word) > self.threshold
        return self.known[word]

    def spans(self, text: str, base) -> list[tuple[int, int, str]]:
        """Base spans and the words that the models add; those never overlap a base span."""
        added = [(start, start + len(word), "markov") for start, word in _free(text, base) if self.random(word)]
        return sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2]))) if added else base


def train(docs: DataFrame) -> Models:
    """Models from the transition counts over all documents; the counts are a table of fixed size."""
    counts = np.zeros((2, STATES, STATES), np.int64)
    rows = docs.select("text").mapInArrow(tidy(_train), "label int, before int, after int, n long")
    for r in rows.groupBy("label", "before", "after").agg(F.sum("n").alias("n")).collect():
        counts[r["label"], r["before"], r["after"]] = r["n"]
    return Models(counts)


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(table, keep_text):
    def run(batches):
        models = table.value
        for batch in batches:
            names = batch.schema.names
            out = {c: [] for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            texts = []
            for text in values(batch.column(names.index("text"))):
                base = base_spans(text or "")
                kinds = [k for _, _, k in base]
                for k in ("assign", "access", "hex"):
                    out[f"n_{k}"].append(kinds.count(k))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                every = models.spans(text or "", base)
                out["spans"].append(joined(every))
                if keep_text:
                    texts.append(text if text is None else redacted(text, every))
            if keep_text:
                columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(k) for k, c in enumerate(names)]
                yield pa.RecordBatch.from_arrays(columns, names)
            else:
                kept = [batch.column(k) for k, c in enumerate(names) if c != "text"]
                types = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64()}
                yield pa.RecordBatch.from_arrays(
                    [*kept, *[pa.array(v, types.get(c, pa.string())) for c, v in out.items()]],
                    [*[c for c in names if c != "text"], *out])
    return tidy(run)


def redacted(text: str, spans, mark: str = "[SECRET]") -> str:
    """The text with every span replaced by a mark; overlapping spans share one."""
    parts, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every whole text.

    Spans are ``kind:start:end`` in code points, end exclusive, comma-joined by start and
    then by kind.  A null or empty text has none.  Every row, repeated ones too, gives a
    row; extra columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = docs.sparkSession.sparkContext.broadcast(train(texts))
    return texts.mapInArrow(
        _scan(table, False), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every secret of their texts replaced by a mark; all columns and rows stay."""
    table = docs.sparkSession.sparkContext.broadcast(train(docs))
    return docs.mapInArrow(_scan(table, True), docs.schema)
