"""Toxicity: a weighted finite-state grammar over the clauses of a text.

A lexicon maps each word to a symbol (insult, threat, target, negation, report,
copula, determiner) with a weight. Small transducers rewrite the symbol string of a
clause and are composed into one machine:

* ``negation`` turns an insult shortly after a negation into a weak one,
* ``report`` does so for an insult shortly after a verb of reported speech,
* ``insult`` accepts an insult that the clause throws at someone: beside a word that
  addresses a person (strengthened), as an epithet behind a copula or on top of
  another insult, or as a clause of its own ("what a fool"),
* ``threat`` matches a threat verb that has a target in the same clause.

Words without a symbol are read as ``o``. The score of a clause is the sum of
its matched weights, that of a text 1 - prod(1 - p) over its clauses. An insult word
that no pattern accepts ("the garbage truck came") counts only a share of its
weight: ``LONE`` for words of the seed list, so that one of them alone stays far
below the threshold, and for learnt words as much as the labels bear out.

The insult lexicon is learnt from labelled documents: words, and prefixes that
many different words share (inflected insults), whose documents are toxic far
more often than chance. Threats, targets, negations and reports are small
closed classes and written by hand.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import cut, held_out, labelled_sample

#: Closed classes of the grammar (English, French, German, Spanish).
TARGETS = frozenset("you your yours yourself u tu toi vous votre du dich dir ihr euch tú te ti usted ustedes vosotros".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't nor pas jamais nicht kein keine nie nunca jamás".split())
REPORTS = frozenset("said says say called calls quoted quote wrote reported according dit appelé sagte nannte dijo llamó".split())
THREATS = frozenset("kill hurt destroy beat shoot stab burn murder tuer frapper töten schlagen matar golpear".split())
COPULAS = frozenset("am is are was were be been est es sont suis était bin bist ist sind seid war soy eres son era".split())
DETERMINERS = frozenset("a an the this that such what un une le la les des quel quelle ein eine einen der die das so el los las qué".split())
#: Insults that hold before any label is seen: word and weight.
SEED_INSULTS = dict.fromkeys("idiot moron stupid scum loser pathetic worthless disgusting clown trash garbage filth dumb imbécile crétin arschloch dummkopf estúpido imbécil".split(), 2.0)

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;:\n]+")
#: Prefix lengths (code points) from which inflected insults are learnt.
PREFIXES = (4, 5, 6)
#: How many words a negation or report reaches forward, an address back to an insult.
REACH = 4
#: How many words may stand between a copula and an epithet.
BETWEEN = 2
#: Share of its weight that an insult word of the seed list has by itself.
LONE = 0.25


def words_of(text: str) -> list[str]:
    """The words of a text, or clause, as the lexicon holds them: learning and scoring
    both read texts through this."""
    return WORD.findall(text.lower())


@dataclass
class Fst:
    """Deterministic weighted transducer. ``arcs[(state, symbol)]`` is
    (next state, output symbol, weight factor); a symbol without an arc is
    copied and the state kept."""

    start: object
    arcs: dict = field(default_factory=dict)

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (state, symbol, 1.0)

    def compose(self, other: "Fst", alphabet: str) -> "Fst":
        """The machine that feeds this one's output to ``other``."""
        start = (self.start, other.start)
        out, todo, seen = Fst(start), [start], {start}
        while todo:
            here = todo.pop()
            for symbol in alphabet:
                s, mid, w = self.step(here[0], symbol)
                t, last, v = other.step(here[1], mid)
                out.arcs[here, symbol] = ((s, t), last, w * v)
                if (s, t) not in seen:
                    seen.add((s, t))
                    todo.append((s, t))
        return out


#: o other, I insult, T target, N negation, R report, H threat, C copula, D determiner,
#: $ end of the clause, and the outputs w (weakened insult), A (insult accepted), S
#: (accepted and strengthened by a target), B (a target that the insult before it
#: addresses), V (the clause was nothing but insults).
ALPHABET = "oITNRHCDwSAB$V"
_PLAIN = "oNRHD"


def _weaken(trigger: str, factor: float) -> Fst:
    """After ``trigger`` an insult within REACH words becomes weak."""
    machine = Fst(0)
    for left in range(REACH + 1):
        machine.arcs[left, trigger] = (REACH, trigger, 1.0)
        for symbol in "oTNRHCDwS":
            if symbol != trigger:
                machine.arcs[left, symbol] = (max(0, left - 1), symbol, 1.0)
        machine.arcs[left, "I"] = (max(0, left - 1), "w" if left else "I", factor if left else 1.0)
    return machine


def _insult() -> Fst:
    """Which insults the clause throws at someone. States: ``open`` (nothing but
    determiners yet), ``alone`` (and insults), ("near", k) (an unaccepted insult within
    reach), ("copula", k), ``aimed`` (a target came), ``free``."""
    machine = Fst("open")
    states = ["open", "alone", "free", *(("near", k) for k in range(1, REACH + 1)), *(("copula", k) for k in range(1, BETWEEN + 2))]
    for state in states:
        kind, k = state if isinstance(state, tuple) else (state, 0)
        later = (kind, k - 1) if k > 1 else "free"
        for symbol in _PLAIN:
            machine.arcs[state, symbol] = (("near", REACH) if state == "alone" else later, symbol, 1.0)
        machine.arcs[state, "C"] = (("copula", BETWEEN + 1), "C", 1.0)
        machine.arcs[state, "T"] = ("aimed", "B" if state == "alone" or kind == "near" else "T", 1.0)
        accepted = state == "alone" or kind == "copula" or state == ("near", REACH)
        machine.arcs[state, "I"] = ("alone" if state in ("open", "alone") else ("near", REACH), "A" if accepted else "I", 1.0)
    machine.arcs["open", "D"] = ("open", "D", 1.0)
    machine.arcs["alone", "$"] = ("open", "V", 1.0)
    machine.arcs["aimed", "I"] = ("aimed", "S", AIMED)
    return machine


def _threat() -> Fst:
    """A threat verb with a target on either side of it in the clause."""
    machine = Fst("none")
    machine.arcs["none", "T"] = ("target", "T", 1.0)
    machine.arcs["none", "H"] = ("verb", "o", 1.0)
    machine.arcs["target", "H"] = ("target", "H", 1.0)
    machine.arcs["verb", "H"] = ("verb", "o", 1.0)
    machine.arcs["verb", "T"] = ("target", "H", 1.0)
    machine.arcs["none", "B"] = ("target", "B", 1.0)
    machine.arcs["verb", "B"] = ("target", "H", 1.0)
    return machine


#: Factor of an insult that a target in its clause addresses.
AIMED = 1.5
GRAMMAR = _weaken("N", 0.1).compose(_weaken("R", 0.2), ALPHABET).compose(_insult(), ALPHABET).compose(_threat(), ALPHABET)
THREAT_WEIGHT = 1.0
#: Weight of a matched clause at which its probability is one half.
HALF = 1.0


@dataclass(frozen=True)
class Lexicon:
    """Insult words and prefixes with their weights, and the share of it that an entry
    has by itself (``LONE`` where none is given)."""

    words: dict
    prefixes: dict
    lone: dict = field(default_factory=dict)

    def entry(self, word: str) -> str | None:
        """The entry that speaks for a word: itself, or its heaviest prefix."""
        if word in self.words:
            return word
        known = [word[:n] for n in PREFIXES if len(word) > n and word[:n] in self.prefixes]
        return max(known, key=self.prefixes.__getitem__, default=None)

    def weight(self, word: str) -> float:
        w = self.words.get(word)
        return w if w is not None else self.prefixes.get(self.entry(word), 0.0)

    def share(self, word: str) -> float:
        return self.lone.get(self.entry(word), LONE)

    def strikes(self, word: str) -> bool:
        """Can this word give a clause its weight?"""
        return word in THREATS or self.weight(word) > 0

    def symbol(self, word: str) -> tuple[str, float]:
        if (w := self.weight(word)) > 0:
            return "I", w
        if word in THREATS:
            return "H", THREAT_WEIGHT
        if word in TARGETS:
            return "T", 0.0
        for symbol, words in (("N", NEGATIONS), ("R", REPORTS), ("C", COPULAS), ("D", DETERMINERS)):
            if word in words:
                return symbol, 0.0
        return "o", 0.0


def clause_score(words: list[str], lexicon: Lexicon) -> float:
    """Sum of the weights that the grammar lets through for one clause."""
    state, total = GRAMMAR.start, 0.0
    last = alone = (0.0, 0.0)  # weight and counted weight: of the last lone insult, of all
    for word in (*words, None):
        symbol, weight = ("$", 0.0) if word is None else lexicon.symbol(word)
        state, out, factor = GRAMMAR.step(state, symbol)
        if out in "AwS":
            total += weight * factor
        elif out == "I":
            last = (weight, weight * lexicon.share(word))
            alone = (alone[0] + last[0], alone[1] + last[1])
            total += last[1]
        elif out == "B":
            total += AIMED * last[0] - last[1]
        elif out == "V":
            total += alone[0] - alone[1]
        elif out == "H":
            total += THREAT_WEIGHT * factor
    return total


#: Words whose ``strikes`` a worker remembers.
CACHE_WORDS = 200_000


def text_score(text: str, lexicon: Lexicon, known: dict) -> tuple[float, int]:
    """(probability that the text is toxic, number of matched clauses).
    ``known`` remembers words already looked up; a text without any insult or
    threat needs no run of the grammar."""
    hit = False
    for word in set(words_of(text)):
        if (strikes := known.get(word)) is None:
            if len(known) >= CACHE_WORDS:
                known.clear()
            strikes = known[word] = lexicon.strikes(word)
        hit = hit or strikes
    clean, matched = 1.0, 0
    for clause in CLAUSE.split(text) if hit else ():
        words = words_of(clause)
        if (total := clause_score(words, lexicon)) > 0:
            matched += 1
            clean *= 1.0 - total * total / (total * total + HALF * HALF)
    return 1.0 - clean, matched


def learn_lexicon(
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = 8000,
    least_docs: int = 4,
    least_words: int = 4,
    purity: float = 20.0,
    cover: int = 3,
    chance: float = 0.01,
) -> Lexicon:
    """Insult words and prefixes from at most ``per_class`` distinct labelled texts
    of each class (the held-out fold is never read).

    Candidates are the words, and the prefixes shared by ``least_words`` words,
    that occur in ``purity`` times as many toxic as clean documents, in
    ``least_docs`` toxic ones, and in so many that among all words and prefixes
    tried ``chance`` such ones are expected where labels say nothing (a bound on
    the binomial tail). Near copies of one toxic text share all their rare words,
    so frequency alone would learn those; the candidates therefore have to explain
    as many documents that fewer than ``cover`` better candidates explain (greedy
    cover; of nested prefixes and words only the best one is taken). Candidates in
    the same documents explain the same, so ``cover`` of them reach the driver, with
    the sampled toxic documents that hold them. Seed words that the labelled texts
    hold as often without being toxic are dropped. Of its weight a learnt entry keeps,
    where no pattern accepts it, the share of toxic documents among those that hold
    it (both classes made equal, one lone seed word added). Without labels the lexicon
    is the seed list.
    """
    distinct_words = F.pandas_udf(lambda texts: pd.Series([sorted(set(words_of(t))) for t in texts]), "array<string>")
    sample = cut(
        labelled_sample(documents, labels, "toxic", per_class).select(
            "y",
            F.monotonically_increasing_id().alias("d"),
            distinct_words("text").alias("ws"),
        ),
        "toxic-sample",
    )
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    words, prefixes, lone = dict(SEED_INSULTS), {}, {}
    if not n1 or not n0:
        return Lexicon(words, prefixes)

    def stems(word: str, *more: str):
        each = [F.struct(F.substring(word, 1, n).alias("p"), F.lit(n).alias("n")) for n in PREFIXES]
        return lambda df: df.select(word, *more, F.explode(F.array(*each)).alias("x")).where(F.length(word) > F.col("x.n"))

    per_word = cut(
        sample.select("y", F.explode("ws").alias("word")).groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")),
        "toxic-words",
    )
    pure = (F.col("t") >= least_docs) & (F.col("t") / n1 >= purity * F.col("c") / n0)
    for r in per_word.where(F.col("word").isin(*SEED_INSULTS) & (F.col("c") >= least_docs) & ~pure).collect():
        del words[r["word"]]
    per_stem = (
        per_word.transform(stems("word", "t", "c"))
        .groupBy(F.col("x.p").alias("word"))
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count_if(F.col("t") > 0).alias("w"))
        .where(F.col("w") >= least_words)
    )
    every = cut(
        per_word.select("word", "t", "c", F.lit(False).alias("stem"))
        .unionByName(per_stem.select("word", "t", "c", F.lit(True).alias("stem")))
        .where(F.col("t") + F.col("c") >= least_docs),
        "toxic-tried",
    )
    surprise = math.log(max(1, every.count()) / chance)
    toxic_share = n1 / (n1 + n0)

    def telling(t: int, c: int) -> bool:
        """Are ``t`` toxic and ``c`` clean documents too many toxic ones for chance?"""
        if t < least_docs or t / n1 < purity * c / n0:
            return False
        share = t / (t + c)
        clean = c * math.log((1 - share) / (1 - toxic_share)) if c else 0.0
        return t * math.log(share / toxic_share) + clean >= surprise

    share = F.col("t") / (F.col("t") + F.col("c"))
    clean = F.when(F.col("c") > 0, F.col("c") * F.log((1 - share) / (1 - toxic_share))).otherwise(0.0)
    candidates = cut(every.where(pure).where(F.col("t") * F.log(share / toxic_share) + clean >= surprise), "toxic-candidates")
    said = sample.where("y = 1").select("d", F.explode("ws").alias("word"))
    held = said.select("d", "word", F.lit(False).alias("stem")).unionByName(
        said.transform(stems("word", "d")).select("d", F.col("x.p").alias("word"), F.lit(True).alias("stem"))
    )
    sets = cut(
        held.join(candidates.drop("t"), ["word", "stem"])
        .groupBy("word", "stem")
        .agg(F.first("c").alias("c"), F.array_sort(F.collect_set("d")).alias("ds"))
        .withColumn("same", F.struct(F.size("ds"), F.xxhash64("ds"), F.hash("ds"))),
        "toxic-sets",
    )
    # The best entry of each beginning, for nested ones are taken once; of these the ``cover`` best.
    rank = F.struct(-F.col("c"), F.length("word"), "word", "stem")
    firsts = sets.groupBy("same", F.substring("word", 1, min(PREFIXES)).alias("begin")).agg(F.max(rank).alias("best"))
    best = firsts.groupBy("same").agg(F.slice(F.sort_array(F.collect_list("best"), asc=False), 1, cover).alias("best"))
    chosen = best.select(F.explode("best").alias("b")).select("b.word", "b.stem")
    found = sets.join(chosen, ["word", "stem"]).select("word", "stem", "c", "ds")
    lone_of = lambda t, c: (t + LONE) / (t + c * n1 / n0 + 1)
    left = {(r["word"], r["stem"]): (r["c"], set(r["ds"])) for r in found.collect()}
    held_by = {e: len(ds) for e, (_, ds) in left.items()}
    needs: dict[int, int] = {}
    while left:
        best = max(left, key=lambda e: (len(left[e][1]) - purity * left[e][0], len(e[0]), e))
        best_c, gain = left.pop(best)
        if len(gain) < least_docs:
            break
        if not telling(len(gain), best_c):
            continue
        (prefixes if best[1] else words)[best[0]] = 3.0
        lone[best[0]] = lone_of(held_by[best], best_c)
        for d in gain:
            needs[d] = needs.get(d, cover) - 1
        done = {d for d in gain if not needs[d]}
        left = {
            (word, stem): (c, rest)
            for (word, stem), (c, ds) in left.items()
            if not ((best[1] and word.startswith(best[0])) or (stem and best[0].startswith(word)))
            and len(rest := ds - done) >= least_docs
        }
    return Lexicon(words, prefixes, lone)


def score_toxicity(documents: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), n_clauses.

    Null and empty texts score 0. Rows that repeat stay; other columns are
    passed over. No shuffle; the lexicon (bounded, see ``learn_lexicon``) goes
    out once as a broadcast variable.
    """
    shared = documents.sparkSession.sparkContext.broadcast((lexicon.words, lexicon.prefixes, lexicon.lone))

    def run(texts: pd.Series) -> pd.DataFrame:
        own, known = Lexicon(*shared.value), {}
        rows = [text_score(t, own, known) if isinstance(t, str) and t else (0.0, 0) for t in texts]
        return pd.DataFrame(rows, columns=["score", "n_clauses"])

    score = F.pandas_udf(run, "score double, n_clauses long")
    return documents.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col)).alias("r")
    ).select("doc_id", "held_out", "r.score", "r.n_clauses")


#: Score from which a document counts as toxic (fixed by the contract).
THRESHOLD = 0.3


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn the lexicon, score every document, decide at THRESHOLD."""
    scored = score_toxicity(documents, learn_lexicon(documents, labels))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
