"""Problem 10: abusive, hateful or sexual passages, however they are spelled.

Three steps over all documents:

1. *Character language model.* Word counts of the whole corpus (partial counts
   per partition, then merged) give a prefix tree whose branch counts are the
   probabilities of the next character given the word so far.
2. *Noisy channel.* A token is a lattice of characters: digits and signs may
   stand for letters, ``*`` for any, letters may be repeated, swapped, dropped,
   or spread with blanks, dots and dashes, where every separator may also end a
   word. Viterbi search over the tree finds the likeliest word or words. A token that the corpus holds stays as it is if it is more
   frequent than a misspelling of that word would be; only shares count, so that
   a misspelling remains one however large the corpus is.
3. *Score.* Features of restored words (words, word pairs and triples of every
   passage, and pairs of concept classes close together) carry log-odds learned
   from the rated documents, the classes a prior besides; a document's score is
   that of its best passage. A rating says that some passage offends, not which:
   a second round counts the heaviest passages of an objectionable document
   as such, and its other passages like those of the others. The cut between the kinds is set on rated documents scored by
   weights they took no part in (folds by content, so that copies stay together).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .leakage import fold

MIN_SHARE = 2e-6  # share of all word occurrences a word of the language model has at least, which bounds the model to 1 / MIN_SHARE words
CLASS_COUNT = 16  # the words of the fixed classes count as seen so often at least
SWAPPED, DOUBLED, DROPPED = 0.05, 0.01, 0.0025  # share of a word's occurrences that one misspelling of a kind makes up at most
MAX_FEATURES = 40_000  # weights kept, the strongest first: the size of the classifier
SURPRISE = (9.0, 5.0)  # log-likelihood ratio at which a feature speaks for the objectionable by more than chance, per round
SURE = 6.4  # score from which a passage explains a document's rating, so that its other passages do not count for it
FOLDS = 5
CUT_RATED = 20  # objectionable documents that must be rated before they set the cut
BEAM = 24
UNKNOWN, CHANGED_GAP, SIGN_GAP = 6.0, 4.0, 2.0  # costs in spread letters: of a letter of no known word, of another separator within a word, of a word's end at a sign
LONGEST = 24  # characters of a word in the lattice, repetitions not counted
REACH = 6  # words between the two parts of a concept pair
SPAN = 12  # words of the window that is scored
MAX_LABELS = 200_000  # rated documents used for fitting at most

# Signs that stand for letters.
LEET = {"@": "a", "4": "a", "3": "e", "€": "e", "1": "il", "!": "il", "|": "il", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t", "8": "b", "9": "g", "6": "g", "2": "z"}
WILD = "*#"

# Word classes, English, German, Spanish and French.
CONCEPTS = {
    "insult": "idiot moron imbecile cretin halfwit loser scumbag bastard bitch asshole dickhead clown rat trash garbage shithead jerk fool dumbass wanker prick slut whore cunt idiots morons imbeciles losers bitches assholes sluts whores savages arschloch versager idioten dreck depp trottel schlampe wichser imbecil idiota cabron basura estupido puta gilipollas pendejo connard connasse salope abruti cretin ordure imbecile encule",
    "adjective": "stupid pathetic worthless useless disgusting filthy miserable repulsive demented braindead brain dumb ugly inutil asqueroso erbarmlicher widerlicher dummes dumme dummer minable sale debile sucio",
    "you": "you your yourself u ya du dich dir dein deine tu te toi ton eres tus ti usted vous votre",
    "group": "women gays migrants immigrants refugees foreigners believers muslims jews christians blacks disabled lesbians trans people folks faith mujeres inmigrantes extranjeros frauen auslander fluchtlinge juden femmes etrangers immigres homosexuels",
    "demean": "vermin parasites filth animals plague subhuman inferior breed disease trash scum cockroaches minderwertiges pack ungeziefer gehoren animales plaga inferiores sirven vermine inferieures chasser echarlos taugen taire",
    "expel": "thrown cleaner locked ruin",
    "violence": "kill drown bleed crash fists teeth punch strangle shoot stab murder rape ahorcate matar partir cara zahne schlag umbringen casser gueule tuer creve",
    "sexual": "naked nude nudes nipples breasts orgasm thrusting moaned panties porn xxx horny hookup oral blowjob escort hardcore sex begged deeper fuck dick pussy cock tits undressed nackt nacktbilder geil stohnte desnuda sexo follarte follar nue baiser baisaient gemissait",
    "go": "fuck screw verpiss vete mierda foutre ferme klappe callate",
}
_CLASS: dict[str, str] = {}
for _name, _words in CONCEPTS.items():
    for _w in _words.split():
        _CLASS.setdefault(_w, _name)

_CUT = re.compile(r"[.!?:;]+(?=\s|$)|\n+|\s[-–—]+\s")
_LETTERS = re.compile(r"[a-z]+")
_SPREAD = re.compile(r"(?<![^\W_])(?<!')[a-z0-9@€$](?:[ .\-_]{1,2}[a-z0-9@€$!|+*#])+[ .\-_]{1,2}[a-z0-9@€$](?![^\W_])")
_PLAIN = re.compile(r"(?<![^\s(\"'])[a-z]+(?=[\s.,;:!?)\"']|$)")
_SEPARATORS = " .-_"
_REPEAT = re.compile(r"([a-z])\1{2,}")
_LONG = re.compile(r"([^*#])\1{2,}")
_DOUBLE = re.compile(r"(.)\1+")
_MOJIBAKE = re.compile("Ã[-¿¡-ÿ©¨ª«¬­®¯°±²³´µ¶·¸¹º»¼½¾¿¡¢£¤¥¦§]")


def repair(text: str) -> str:
    """Undo UTF-8 that was read as Latin-1."""
    if not _MOJIBAKE.search(text):
        return text
    return _MOJIBAKE.sub(lambda m: m.group().encode("latin-1", "ignore").decode("utf-8", "ignore") or m.group(), text)


def _most_misspelt(expected: float) -> float:
    """How often a misspelling expected so often is seen at most, but for chance."""
    return expected + 2 * math.sqrt(expected) + 3


def _typos(token: str) -> int:
    """How many letters of a token may be swapped or dropped; none beside signs."""
    n = len(token)
    return 0 if n < 4 or any(c in WILD or c in LEET for c in token) else 1 if n < 7 else 2


def _share(token: str, word: str) -> float:
    """What share of a word's occurrences a misspelling makes up at most; words of the classes are disguised in any way."""
    if word in _CLASS:
        return SWAPPED
    if _DOUBLE.sub(r"\1", token) == _DOUBLE.sub(r"\1", word):
        return DOUBLED
    return SWAPPED if sorted(token) == sorted(word) else DROPPED


class PrefixModel:
    """Next-character probabilities as a prefix tree of counted words."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts
        self.kids: list[dict[str, int]] = [{}]
        self.mass, self.ends = [0.0], [0.0]
        for w, n in counts.items():
            weight, at = math.sqrt(n), 0
            self.mass[0] += weight
            for c in w:
                nxt = self.kids[at].get(c)
                if nxt is None:
                    nxt = self.kids[at][c] = len(self.kids)
                    self.kids.append({})
                    self.mass.append(0.0)
                    self.ends.append(0.0)
                at = nxt
                self.mass[at] += weight
            self.ends[at] += weight
        self.known: dict[str, str] = {}
        self.plains: dict[str, str] = {}
        self.tokens: dict[str, list[str]] = {}
        self.sure = _most_misspelt(max(counts.values(), default=0) * SWAPPED)  # a more frequent word is no misspelling of any

    def word(self, token: str) -> str:
        """The likeliest word behind a token of letters, digits and signs; the token if none is near, or none that explains how often the token is seen."""
        seen = self.counts.get(token, 0)
        if seen > self.sure or token in _CLASS:
            return token
        got = self.known.get(token)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self._decode(token, seen)
            if got != token:
                if seen and seen > _most_misspelt(self.counts[got] * _share(token, got)):
                    got = token
                else:
                    got = self.word(got)  # more frequent each time, so this ends
            self.known[token] = got
        return got

    def plain(self, token: str) -> str:
        """The word behind a token of letters only; letters repeated three times or more are collapsed first."""
        got = self.plains.get(token)
        if got is None:
            if len(self.plains) > 200_000:
                self.plains.clear()
            got = self.plains[token] = self._plain(token)
        return got

    def _plain(self, token: str) -> str:
        if token in _CLASS or not _REPEAT.search(token):
            return self.word(token)
        once, twice = _REPEAT.sub(r"\1", token), _REPEAT.sub(r"\1\1", token)
        near = max((self.counts.get(x, 0), x) for x in (once, twice))
        if near[0] and (near[0] > 1 or token not in self.counts):
            return self.word(near[1])
        return self.word(token if token in self.counts else twice)

    def _decode(self, token: str, seen: int = 0) -> str:
        """The likeliest word seen more than ``seen`` times; the token if there is none."""
        short = _LONG.sub(r"\1\1", token)
        n = len(short)
        if n > LONGEST or not any(c.isalpha() or c in WILD for c in short) or n < 2:
            return token
        last = self._rows(short, _typos(short))[n]
        best = min(((cost - math.log(self.ends[node] / self.mass[node]), word) for (node, _), (cost, word) in last.items() if self.ends[node] and self.counts[word] > seen), default=None)
        return best[1] if best else token

    def spread(self, letters: str, gaps: list[str]) -> list[tuple[int, str]]:
        """The likeliest words of letters spread with separators, each with the place it ends at.

        ``gaps[i]`` stands after ``letters[i]``. Every gap lies in a word or ends
        one; it costs to change separators within a word and to end one at a sign.
        """
        n = len(letters)
        best: list[tuple[float, int, str]] = [(0.0, 0, "")] + [(math.inf, 0, "")] * n
        for i in range(n):
            piece = letters[i : i + LONGEST]
            rows, changes = self._rows(piece, _typos(piece)), 0
            begun = best[i][0] + (SIGN_GAP if i and " " not in gaps[i - 1] else 0.0)
            for k in range(1, len(piece) + 1):
                changes += k > 2 and gaps[i + k - 2] != gaps[i + k - 3]
                most = _typos(piece[:k])
                ways = [(cost - math.log(self.ends[node] / self.mass[node]), word) for (node, edits), (cost, word) in rows[k].items() if self.ends[node] and edits <= most]
                cost, word = min(ways + [(UNKNOWN * (1 + k), piece[:k])])
                cost += begun + CHANGED_GAP * changes
                if cost < best[i + k][0]:
                    best[i + k] = (cost, i, word)
        found, at = [], n
        while at:
            _, start, word = best[at]
            found.append((at, word))
            at = start
        return found[::-1]

    def _rows(self, token: str, typo: int) -> list[dict[tuple[int, int], tuple[float, str]]]:
        """The states of the search after each character of a token."""
        n, wild = len(token), any(c in WILD for c in token)
        # a state: (tree node, edits) -> (cost, word so far); position by position
        rows: list[dict[tuple[int, int], tuple[float, str]]] = [{} for _ in range(n + 1)]
        rows[0][0, 0] = (0.0, "")
        kids, mass = self.kids, self.mass

        def add(i: int, node: int, edits: int, cost: float, word: str) -> None:
            old = rows[i].get((node, edits))
            if old is None or cost < old[0]:
                rows[i][node, edits] = (cost, word)

        for i in range(n):
            states = sorted(rows[i].items(), key=lambda s: s[1][0])
            if not wild:
                states = states[:BEAM]
            c = token[i]
            for (node, edits), (cost, word) in states:
                options = kids[node]
                if c in WILD:
                    for x, k in options.items():
                        add(i + 1, k, edits, cost - math.log(mass[k] / mass[node]), word + x)
                    continue
                for x in c if c.isalpha() else LEET.get(c, ""):
                    k = options.get(x)
                    if k is not None:
                        add(i + 1, k, edits, cost - math.log(mass[k] / mass[node]), word + x)
                if word and c == word[-1]:
                    add(i + 1, node, edits, cost + 1.0, word)  # repetition
                if edits < typo:
                    for x, k in options.items():  # a dropped letter
                        k2 = kids[k].get(c)
                        if k2 is not None and word:
                            add(i + 1, k2, edits + 1, cost + 6.0 - math.log(mass[k2] / mass[node]), word + x + c)
                    if i + 1 < n and (k := options.get(token[i + 1])) is not None and (k2 := kids[k].get(c)) is not None:
                        add(i + 2, k2, edits + 1, cost + 3.0 - math.log(mass[k2] / mass[node]), word + token[i + 1] + c)
        return rows


def join_spread(text: str, model: PrefixModel) -> str:
    """A folded text with the words whose letters stand apart written together, the separators between such words kept."""

    def joined(m: re.Match) -> str:
        run = m.group()
        if sum(c.isalpha() for c in run) < 2:
            return run
        letters = "".join(c for c in run if c not in _SEPARATORS)
        gaps = re.findall(r"[ .\-_]+", run)
        parts = model.spread(letters, gaps)
        return "".join(w + ("" if at == len(letters) else gaps[at - 1] if " " in gaps[at - 1] else " ") for at, w in parts)

    return _SPREAD.sub(joined, text)


def restored(token: str, model: PrefixModel) -> list[str]:
    """The words behind a token between blanks; a figure is 0, mere signs are none."""
    t = token.strip(".,;:!?\"'()[]{}<>~^`=/\\") if not token.isalpha() else token
    if t.isalpha():
        return [model.plain(t)]
    if not t or t.isdigit():
        return ["0"] if t else []
    if any(c in LEET or c in WILD for c in t) and any(c.isalpha() or c in WILD for c in t):
        return [model.word(t)]
    return [model.plain(x) for x in _LETTERS.findall(t.replace("'", ""))]


def passages(text: str | None, model: PrefixModel) -> list[list[str]]:
    """The passages of a text as restored words."""
    if not text:
        return []
    out, known = [], model.tokens
    for part in _CUT.split(join_spread(fold(repair(text)), model)):
        if not part:
            continue
        ws: list[str] = []
        for m in part.split():
            got = known.get(m)
            if got is None:
                if len(known) > 200_000:
                    known.clear()
                got = known[m] = restored(m, model)
            ws += got
        if ws:
            out.append(ws)
    return out


def first_words(weights: dict[str, float]) -> set[str]:
    """The words that weighted features of words begin with."""
    return {f.partition(" ")[0] for f in weights if not f.startswith("<")}


def telling_words(weights: dict[str, float], counts: dict[str, int]) -> set[str]:
    """Words without any of which no passage scores: the rarest of each feature that speaks for the objectionable, and the classes."""
    return {min(f.split(" "), key=lambda w: counts.get(w, 0)) for f, w in weights.items() if w > 0 and not f.startswith("<")} | set(_CLASS)


def features(ws: list[str], heads: set[str] | None = None) -> list[tuple[int, str]]:
    """``(place, feature)``: words, word pairs and triples of any passage, those that begin with one of ``heads`` if given, and concept pairs within reach."""
    marks = [(i, _CLASS[w]) for i, w in enumerate(ws) if w in _CLASS]
    at = range(len(ws)) if heads is None else [i for i, w in enumerate(ws) if w in heads]
    got = [(i, " ".join(ws[i : i + k])) for i in at for k in (1, 2, 3) if i + k <= len(ws)]
    for a, (i, x) in enumerate(marks):
        for j, y in marks[a + 1 :]:
            if j - i > REACH:
                break
            got.append((i, f"<{min(x, y)}|{max(x, y)}>"))
    return got


def score_words(ws: list[str], found: list[tuple[int, str]], weights: dict[str, float], span: int = SPAN) -> tuple[float, int]:
    """Score and start of the heaviest window of ``span`` words or fewer; a feature counts once a passage."""
    at, seen = [0.0] * len(ws), set()
    for i, f in found:
        w = weights.get(f)
        if w is not None and f not in seen:
            seen.add(f)
            at[i] += w
    best, start = 0.0, 0
    for i, w in enumerate(at):
        if w > 0:
            score = max(accumulate(at[i : i + span]))
            if score > best:
                best, start = score, i
    return best, start


class Judge:
    """Scores texts by learned weights."""

    def __init__(self, model: PrefixModel, weights: dict[str, float], span: int = SPAN) -> None:
        self.model, self.weights, self.span = model, weights, span
        self.heads = first_words(weights)
        self.speaking = {f: w for f, w in weights.items() if w > 0}
        self.speaking_heads = first_words(self.speaking)
        self.telling = telling_words(weights, model.counts)

    def best_passage(self, text: str | None) -> tuple[float, str]:
        """Score and words of the best passage of a text."""
        top, words = 0.0, ""
        for ws in passages(text, self.model):
            if self.telling.isdisjoint(ws):
                continue
            if sum(self.speaking.get(f, 0.0) for _, f in set(features(ws, self.speaking_heads))) <= top:
                continue  # what speaks for it is no more than another passage's score
            score, i = score_words(ws, features(ws, self.heads), self.weights, self.span)
            if score > top:
                top, words = score, " ".join(ws[i : i + self.span])
        return top, words


def word_counts(documents: DataFrame, min_share: float = MIN_SHARE) -> dict[str, int]:
    """Counts of the corpus's words over all documents, of those with at least that share of all; the fixed classes are always in."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(set(_PLAIN.findall(fold(repair(text)))))
            if len(seen) > 300_000:
                yield out()
                seen.clear()
        if seen:
            yield out()

    counted = documents.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        least = (counted.agg(F.sum("n")).first()[0] or 0) * min_share
        rows = counted.where(F.col("n") >= least).collect()
    finally:
        counted.unpersist()
    counts = {r["word"]: r["n"] for r in rows if len(r["word"]) > 1 or r["word"] in "aiuyoe"}
    for w in _CLASS:
        counts[w] = max(counts.get(w, 0), CLASS_COUNT)
    return counts


def _restored(documents: DataFrame, labels: DataFrame, counts: dict[str, int]) -> DataFrame:
    """``(bad, fold, said)`` of the rated documents: the rating of the majority (ties left out), a fold by content, and the restored passages.

    At most ``MAX_LABELS`` ratings are used, so their ids may be broadcast whatever the corpus.
    """
    votes = labels.where(F.col("doc_id").isNotNull() & F.col("objectionable").isNotNull()).groupBy("doc_id").agg(F.avg("objectionable").alias("v"))
    rated = votes.where(F.col("v") != 0.5).orderBy(F.xxhash64("doc_id")).limit(MAX_LABELS).select("doc_id", (F.col("v") > 0.5).alias("bad"))
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(rated), "doc_id").select("bad", "text")
    sent = documents.sparkSession.sparkContext.broadcast(counts)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PrefixModel(sent.value)
        for batch in batches:
            said = [[" ".join(ws) for ws in passages(t, model)] for t in batch.column("text").to_pylist()]
            part = [zlib.crc32("\n".join(s).encode()) % FOLDS for s in said]
            yield pa.RecordBatch.from_arrays([batch.column("bad"), pa.array(part, pa.int32()), pa.array(said, pa.list_(pa.string()))], ["bad", "fold", "said"])

    return texts.mapInArrow(restore, "bad boolean, fold int, said array<string>")


def _blamed(said: list[list[str]], weights: dict[str, float]) -> tuple[float, set[str], set[str]]:
    """Best score of a document, the features of the passages that speak for it, and those of the passages that do not.

    A passage speaks for the rating if it scores a quarter of the best one; all do where none is sure.
    """
    each = [features(ws) for ws in said]
    scores = [score_words(ws, found, weights)[0] for ws, found in zip(said, each)]
    best = max(scores, default=0.0)
    inside: set[str] = set()
    outside: set[str] = set()
    for found, score in zip(each, scores):
        (inside if best < SURE or score >= best / 4 else outside).update(f for _, f in found)
    return best, inside, outside - inside


def learn_weights(documents: DataFrame, labels: DataFrame, counts: dict[str, int]) -> tuple[dict[str, float], float]:
    """Log-odds of features between objectionable and other passages of rated documents, and the cut between the kinds.

    Features are counted once a document and merged across partitions. One seen
    in fewer than four documents, or only somewhat more in one kind, has no
    weight, nor has one that may speak for the objectionable by chance; concept
    pairs start from a prior, so that few labels suffice. The cut is that of the
    best F1 over documents scored by the other folds' weights, and not below
    ``THRESHOLD``, which holds where there are no labels.
    """
    context = documents.sparkSession.sparkContext
    rated = _restored(documents, labels, counts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {(r["fold"], r["bad"]): r["count"] for r in rated.groupBy("fold", "bad").count().collect()}
        if not sizes:
            return dict(PRIOR), THRESHOLD
        fits: list[dict[str, float]] | None = None
        for surprise in SURPRISE:
            sent = context.broadcast(fits)

            def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    names, fold, bad = [], [], []
                    for b, k, said in zip(*(batch.column(i).to_pylist() for i in range(3))):
                        split = [s.split(" ") for s in said]
                        if sent.value is None or not b:
                            parts = [(int(b), {f for ws in split for _, f in features(ws)})]
                        else:
                            _, inside, outside = _blamed(split, sent.value[k])
                            parts = [(1, inside), (0, outside)]
                        for label, found in parts:
                            names += found
                            fold += [k] * len(found)
                            bad += [label] * len(found)
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(fold, pa.int32()), pa.array(bad, pa.int32())], ["f", "fold", "bad"])

            told = [F.count_if((F.col("fold") == k) & (F.col("bad") == b)).alias(f"c{k}{b}") for k in range(FOLDS) for b in (0, 1)]
            fits = _fit(rated.mapInArrow(count, "f string, fold int, bad int").groupBy("f").agg(*told), sizes, surprise)
        sent = context.broadcast(fits)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad, fold, said = (batch.column(i).to_pylist() for i in range(3))
                best = [_blamed([s.split(" ") for s in x], sent.value[k])[0] for k, x in zip(fold, said)]
                yield pa.RecordBatch.from_arrays([pa.array(bad, pa.bool_()), pa.array(best, pa.float64())], ["bad", "score"])

        judged = [(r["score"], r["bad"]) for r in rated.mapInArrow(judge, "bad boolean, score double").collect()]
    finally:
        rated.unpersist()
    return fits[FOLDS], best_cut(judged)


def _fit(stats: DataFrame, sizes: dict[tuple[int, bool], int], least_surprise: float) -> list[dict[str, float]]:
    """Weights by all folds but the first, all but the second and so on, and last by all, from the counts of each feature, in one action."""
    shown = []
    for left_out in range(FOLDS + 1):
        folds = [k for k in range(FOLDS) if k != left_out]
        bad_all, good_all = (max(1, sum(sizes.get((k, b), 0) for k in folds)) for b in (True, False))
        p, q = (reduce(lambda x, y: x + y, [F.col(f"c{k}{b}") for k in folds]) for b in (1, 0))
        n, base = p + q, bad_all / (good_all + bad_all)
        w = F.log((p + 0.1) / (q + 0.4)) + F.lit(math.log(good_all / bad_all))
        surprise = F.when(p > 0, p * F.log(p / (n * base))).otherwise(0.0) + F.when(q > 0, q * F.log(q / (n * (1 - base)))).otherwise(0.0)
        pair = F.startswith(F.col("f"), F.lit("<"))
        use = ((n >= 4) & (((w > 3.0) & (surprise > least_surprise)) | (w < -1.2))) | (pair & (n > 0))
        shown.append(F.when(use, F.struct((n / (n + 3.0) * F.greatest(F.lit(-4.0), F.least(F.lit(4.0), w))).alias("w"), (3.0 / (n + 3.0)).alias("prior"))).alias(f"w{left_out}"))
    names = [f"w{k}" for k in range(FOLDS + 1)]
    weighty = F.greatest(*[F.abs(F.coalesce(F.col(f"{x}.w"), F.lit(0.0))) for x in names], F.lit(0.0))
    strong = stats.select("f", *shown).where(F.coalesce(*[F.col(f"{x}.w") for x in names]).isNotNull()).orderBy(F.desc(weighty), "f").limit(MAX_FEATURES).collect()
    fits = [dict(PRIOR) for _ in names]
    for r in strong:
        for x, fit in zip(names, fits):
            if r[x] is not None:
                fit[r["f"]] = r[x]["w"] + r[x]["prior"] * PRIOR.get(r["f"], 0.0)
    return fits


def best_cut(judged: list[tuple[float, bool]]) -> float:
    """The score between the two kinds with the best F1, midway to the next lower one; ``THRESHOLD`` at least, and where too few objectionable documents are rated."""
    order = sorted((x for x in judged if x[0] >= THRESHOLD), reverse=True)
    all_bad = sum(b for _, b in judged)
    if all_bad < CUT_RATED:
        return THRESHOLD
    best, cut, hits = 0.0, THRESHOLD, 0
    for k, (score, bad) in enumerate(order, 1):
        hits += bad
        lower = order[k][0] if k < len(order) else THRESHOLD
        if score > lower and (f1 := 2 * hits / (k + all_bad)) > best:
            best, cut = f1, (score + lower) / 2
    return cut


# What a pair of classes close together says before any label is seen.
PRIOR = {"<insult|you>": 2.5, "<adjective|insult>": 3.3, "<adjective|you>": 1.0, "<demean|group>": 3.3, "<expel|group>": 1.5, "<sexual|sexual>": 3.3, "<violence|you>": 1.5, "<violence|violence>": 1.5, "<go|you>": 2.0, "<go|violence>": 4.0, "<go|go>": 3.0, "<go|insult>": 3.3, "<insult|insult>": 1.5, "<insult|violence>": 3.3, "<sexual|you>": 2.0, "<group|violence>": 3.3, "<demean|demean>": 1.5}
THRESHOLD = 3.2  # the least sum of log-odds that tells an objectionable passage


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, source, score, passage)`` of every document; a score of 1 or more is past the learned cut.

    Null and empty texts score 0; repeated rows are scored each; without labels
    the fixed classes alone decide. No documents give no rows.
    """
    counts = word_counts(documents)
    weights, cut = learn_weights(documents, labels, counts)
    sent = documents.sparkSession.sparkContext.broadcast((counts, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(PrefixModel(sent.value[0]), sent.value[1])
        for batch in batches:
            got = [judge.best_passage(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array([s / cut for s, _ in got], pa.float64()), pa.array([p for _, p in got], pa.string())], ["doc_id", "source", "score", "passage"])

    return documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").mapInArrow(run, "doc_id long, source string, score double, passage string")
