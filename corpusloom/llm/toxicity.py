"""Toxicity by a weighted finite-state grammar of clauses (operator 5).

Tokens become classes (insult, threat, target, negation, report, quote, boundary,
other). Five weighted transducers are composed over them: one for insults, one for
threats, one for a clause that names its target beside either, one for those that
a negation reaches, one for those that are reported speech. Every arc has a
weight, weights add along the path, and a last transducer closes each clause. A
clause with an insult or threat is matched, its score is the weight of its path,
and a text's score is the log sum over its matched clauses: single words outside
a clause's path count for nothing.

The arcs' weights are learned from labels: run with unit vectors for weights, the
same machine counts which arcs a path takes, and the log loss of the labelled
texts is lowered under a normal prior round ``PRIOR``, in the order of ids, so that
reruns agree to the last bit. The insult lexicon has published words for four
languages; further stems are learned from the labelled rows as word beginnings
that set toxic texts apart. Labels are read only for training; language, source
and id are no inputs.

Null and empty texts, like all without a match, get the score of the bias alone;
texts of any length are read whole. A quotation that is never closed ends after
``QUOTED`` clauses. Repeated rows get equal scores, a row each, and an empty table
gives an empty result. Duplicate labels of an id count once, as the larger. Used
to fit are at most ``train_rows`` labelled ids, the first by a hash of the id (ties
by the id), with one text each, the least of an id's; texts of more than
``TRAIN_CHARS`` characters are not used to fit. Without labels the prior weights
stand. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.storage import materialize, ship_package
from corpusloom.llm.transducers import ANY, Transducer

#: Bounds of the labelled sample: rows, and characters a text. Words of these rows are all that reaches the driver.
TRAIN_ROWS, TRAIN_CHARS = 12_000, 32_000

#: Word lists of the grammar, in lower case; a word in INSULTS matches as a whole word.
INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid scum loser losers trash worthless pathetic disgusting clown clowns dumb imbecile vermin filth garbage freak creep jerk bastard bitch whore slut "
    "fool fools foolish coward cowards cretin retard retarded dimwit halfwit nitwit numbskull blockhead dunce simpleton degenerate parasite parasites maggot maggots lowlife scumbag dirtbag asshole "
    "dickhead wanker prick cunt skank despicable repulsive revolting useless brainless clueless spineless "
    "dummkopf abschaum arschloch trottel schwachkopf hurensohn drecksack mistkerl vollidiot depp blödmann wichser miststück schlampe hure drecksau versager nichtsnutz hornochse ekelhaft widerlich "
    "erbärmlich wertlos feigling spinner idiotin "
    "connard salaud imbécile débile ordure crétin abruti connasse salope raclure pourriture minable pathétique dégueulasse bouffon lâche stupide enfoiré bâtard crétine idiote "
    "idiota imbécil estúpido estúpida basura escoria gilipollas cabrón tonto cretino pendejo puta zorra maldito asqueroso repugnante patético inútil payaso cobarde bastardo mierda"
).split()
THREATS = (
    "kill murder hurt destroy beat stab shoot strangle bury burn slaughter butcher behead torture maim crush choke drown "
    "töten umbringen vernichten erschlagen abstechen erschießen verprügeln zerstören ermorden abschlachten "
    "tuer détruire frapper égorger assassiner massacrer étrangler poignarder écraser tabasser "
    "matar destruir golpear apuñalar asesinar masacrar estrangular aplastar destrozar degollar"
).split()
TARGETS = "you your yours yourself u ur he she they them him her his their these those people du dich dir dein deine euch ihr sie er tu toi ton ta tes vous votre il elle ils elles usted ustedes tú te tus ellos ellas".split()
NEGATIONS = "not no never isn't aren't wasn't ain't don't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún tampoco".split()
REPORTS = "said says say called calls quoted reported claimed wrote writes alleged told sagte sagt nannte berichtet dit disait appelé rapporté dijo llamó escribió".split()
QUOTES = "\"“”„«»"

#: Words after a negation that it still reaches, and clauses that an unclosed quotation lasts.
REACH, QUOTED = 3, 3
#: The grammar's weights before any label is seen, and the bias of a text: a clause with an insult is enough to pass 0.3, one with a bare threat is not.
PRIOR = {"insult": 4.0, "threat": 1.0, "more": 0.5, "aimed_insult": 1.5, "aimed_threat": 3.0, "denied": -2.0, "told": -2.0}
NAMES, BIAS = tuple(PRIOR), -3.5

_TOKEN = re.compile(r"[\w'’]+|[.!?;\n\"“”„«»]")
_BOUNDARY = frozenset(".!?;\n")
_STEM = re.compile(r"\w+")


def negation(w: dict) -> Transducer:
    """Weighs I and T within REACH tokens of a negation."""
    arcs = {}
    for left in range(REACH + 1):
        fewer, weight = max(0, left - 1), w["denied"] if left else w[None]
        arcs |= {(left, "N"): (REACH, "N", w[None]), (left, "."): (0, ".", w[None]), (left, ANY): (fewer, ANY, w[None]), (left, "I"): (fewer, "I", weight), (left, "T"): (fewer, "T", weight)}
    return Transducer(0, arcs)


def reported_speech(w: dict) -> Transducer:
    """Weighs I and T after a verb of report until the clause ends, and in a quotation that follows one until it is closed."""
    quoted = [f"quoted{k}" for k in range(QUOTED)]
    arcs = {}
    for state in ("plain", "told", *quoted):
        weight = w[None] if state == "plain" else w["told"]
        arcs |= {(state, "I"): (state, "I", weight), (state, "T"): (state, "T", weight), (state, ANY): (state, ANY, w[None]), (state, "R"): ("told" if state == "plain" else state, "R", w[None])}
    arcs |= {("plain", "."): ("plain", ".", w[None]), ("told", "."): ("plain", ".", w[None]), ("plain", '"'): ("plain", '"', w[None]), ("told", '"'): (quoted[0], '"', w[None])}
    for state, later in zip(quoted, [*quoted[1:], "plain"], strict=True):
        arcs |= {(state, "."): (later, ".", w[None]), (state, '"'): ("plain", '"', w[None])}
    return Transducer("plain", arcs)


def hits(symbol: str, first, w: dict) -> Transducer:
    """Weighs the first of a symbol in a clause, and each further one as more."""
    arcs = {(state, "."): (0, ".", w[None]) for state in (0, 1)} | {(state, ANY): (state, ANY, w[None]) for state in (0, 1)}
    return Transducer(0, arcs | {(0, symbol): (1, symbol, first), (1, symbol): (1, symbol, w["more"])})


def target(w: dict) -> Transducer:
    """Weighs a clause once that names a target before or after an insult or threat."""
    arcs = {}
    for state in ("none", "target", "insult", "threat", "aimed"):
        arcs |= {(state, "."): ("none", ".", w[None]), (state, ANY): (state, ANY, w[None])}
    arcs |= {("none", "Y"): ("target", "Y", w[None]), ("none", "I"): ("insult", "I", w[None]), ("none", "T"): ("threat", "T", w[None]), ("insult", "T"): ("threat", "T", w[None])}
    arcs |= {("target", "I"): ("aimed", "I", w["aimed_insult"]), ("target", "T"): ("aimed", "T", w["aimed_threat"]), ("insult", "Y"): ("aimed", "Y", w["aimed_insult"]), ("threat", "Y"): ("aimed", "Y", w["aimed_threat"])}
    return Transducer("none", arcs)


def clause_end(w: dict) -> Transducer:
    """Says at each boundary whether the clause was matched, and nothing in between."""
    arcs = {(state, ANY): (state, "", w[None]) for state in (False, True)} | {(state, hit): (True, "", w[None]) for state in (False, True) for hit in "IT"}
    return Transducer(False, arcs | {(state, "."): (False, "matched" if state else "free", w[None]) for state in (False, True)})


def machine(w: dict) -> Transducer:
    """The composed grammar; w: a weight for each name, and the neutral weight for None."""
    return negation(w) @ reported_speech(w) @ hits("I", w["insult"], w) @ hits("T", w["threat"], w) @ target(w) @ clause_end(w)


UNITS = dict(zip(NAMES, np.eye(len(NAMES)), strict=True)) | {None: np.zeros(len(NAMES))}


class Grammar:
    """The composed transducers over a lexicon with learned stems; without weights their paths count arcs."""

    def __init__(self, stems: tuple[str, ...] = (), weights: dict[str, float] | None = None):
        self.classes = {w: c for words, c in ((TARGETS, "Y"), (NEGATIONS, "N"), (REPORTS, "R"), (THREATS, "T"), (INSULTS, "I")) for w in words}
        self.classes |= dict.fromkeys(_BOUNDARY, ".") | dict.fromkeys(QUOTES, '"')
        self.stems = frozenset(stems)
        self.lengths = sorted({len(s) for s in stems})
        self.heads = frozenset(s[: self.lengths[0]] for s in stems)
        self.machine = machine(weights | {None: 0.0} if weights else UNITS)
        self.whole = frozenset({*INSULTS, *THREATS})

    def token_class(self, token: str) -> str:
        found = self.classes.get(token)
        if found is None:
            # outer quotes and clitics stand off: 'moron', idiot's, you're, l'abruti
            whole = token.replace("’", "'").strip("'")
            words = (whole, *whole.split("'"))
            found = next((self.classes[w] for w in words if w in self.classes), None)
            found = found or ("I" if any(w[:n] in self.stems for w in words for n in self.lengths) else "O")
        return found

    def triggered(self, lower: str) -> bool:
        """Whether any word could be an insult or a threat: most texts end here."""
        words = set(_STEM.findall(lower))
        if not self.whole.isdisjoint(words):
            return True
        # few words share a stem's first letters, and only these are looked at further
        return bool(self.lengths) and not self.heads.isdisjoint([w[: self.lengths[0]] for w in words]) and any(not self.stems.isdisjoint([w[:n] for w in words]) for n in self.lengths)

    def symbols(self, lower: str) -> list[str]:
        return [*map(self.token_class, _TOKEN.findall(lower)), "."]

    def clauses(self, text: str | None) -> list:
        """The path weight of each matched clause, in order."""
        lower = (text or "").lower()
        return path_weights(self.machine, self.symbols(lower)) if self.triggered(lower) else []


def path_weights(composed: Transducer, symbols: list[str]) -> list:
    """Weights summed along each clause's path, for the clauses that are matched."""
    out, total = [], 0.0
    for said, weight in composed.run(symbols):
        total = total + weight
        if said:
            if said == "matched":
                out.append(total)
            total = 0.0
    return out


def text_score(weights: list[float], bias: float) -> float:
    """The logistic of the bias plus the log sum of the clauses' exponentials and one."""
    logit = bias + float(np.logaddexp.reduce([0.0, *weights]))
    return 1 / (1 + float(np.exp(-logit)))


def beginnings(words: set[str], longest: int = 12) -> set[str]:
    """Word beginnings of 4 to longest letters."""
    return {w[:n] for w in words for n in range(4, min(len(w), longest) + 1)}


def unlike(rows: list[set[str]], size: int = 16) -> list[set[str]]:
    """Of word sets that share half of their words or more, as the words of least hash tell, the first one; in time in proportion."""
    out: list[set[str]] = []
    holders: dict[str, list[tuple[int, int]]] = {}
    for words in rows:
        sketch = sorted(words, key=lambda w: (crc32(w.encode()), w))[:size]
        shared: Counter[tuple[int, int]] = Counter()
        for w in sketch:
            shared.update(holders.get(w, ()))
        if not any(2 * n >= max(length, len(sketch)) for (_, length), n in shared.items()):
            for w in sketch:
                holders.setdefault(w, []).append((len(out), len(sketch)))
            out.append(words)
    return out


def learn_stems(rows: list[tuple[str, int]], least: int = 4, strength: float = 12.0, purity: float = 0.95, again: float = 0.5) -> tuple[str, ...]:
    """Word beginnings that set toxic rows apart; rows: distinct words joined by spaces, and the label.

    Greedy: the strongest one explains its rows, which count for ``again`` as much each
    time that they are explained. So words that merely stand near insults drop out, while
    a root that many endings follow gets the beginnings that clean texts hardly hold. At
    least ``purity`` of the rows with a stem are toxic, and ``least`` of them are. Texts
    that are nearly copies count once, so what they share is no evidence.
    """
    rows = sorted(set(rows))
    toxic = [words for words, label in rows if label]
    unknown = unlike([w for w in (set(words.split()) for words in toxic) if w.isdisjoint(INSULTS)])
    counts: Counter[str] = Counter()
    for words in unknown:
        counts.update(beginnings(words))
    counts = Counter({s: a for s, a in counts.items() if a >= least})
    clean: Counter[str] = Counter()
    for words, label in rows:
        if not label:
            clean.update(beginnings(set(words.split())) & counts.keys())
    pure = {s for s, a in counts.items() if a >= purity * (a + clean[s])}
    base = max(1, len(toxic)) / (max(1, len(toxic)) + max(1, len(rows) - len(toxic)))
    counts = Counter({s: counts[s] for s in pure})
    left = [(beginnings(words) & pure, 1.0) for words in unknown]

    def strong(stem: str) -> float:
        a, b = counts[stem], clean[stem]
        rate = a / (a + b)
        if rate <= base:
            return 0.0
        return 2 * (a * np.log(rate / base) + (b * np.log((1 - rate) / (1 - base)) if b else 0.0))

    stems: list[str] = []
    while counts:
        best = max(counts, key=lambda s: (strong(s), -clean[s], len(s), s))
        if strong(best) < strength:
            break
        stems.append(best)
        for longer in [s for s in counts if s.startswith(best)]:
            del counts[longer]
        shorter = {best[:n] for n in range(4, len(best))}
        rest = []
        for found, worth in left:
            if best in found:
                # the same words are no second reason for a shorter beginning
                for s in found & counts.keys():
                    counts[s] -= worth if s in shorter else worth * (1 - again)
                found, worth = (found - shorter) & counts.keys(), worth * again
            rest.append((found, worth))
        left = rest
        counts = Counter({s: a for s, a in counts.items() if a > 1})
    return tuple(stems)


def fit(clauses: list[np.ndarray], toxic: np.ndarray, pull: float = 1.0, rounds: int = 600, rate: float = 0.05) -> tuple[dict[str, float], float]:
    """Arc weights and bias by gradient steps; clauses: for each text its matched clauses' arc counts, a row each."""
    prior = np.array([*PRIOR.values(), BIAS])
    if not len(toxic):
        return dict(PRIOR), BIAS
    x = np.concatenate([c.reshape(-1, len(NAMES)) for c in clauses])
    text = np.repeat(np.arange(len(toxic)), [len(c) for c in clauses])
    strength = np.array([pull] * len(NAMES) + [0.05])
    w, m, v = prior.copy(), np.zeros(len(prior)), np.zeros(len(prior))
    for k in range(1, rounds + 1):
        e = np.exp(np.clip(x @ w[:-1], -30, 30))
        z = 1 + np.bincount(text, e, len(toxic))
        wrong = 1 / (1 + np.exp(-(w[-1] + np.log(z)))) - toxic
        g = np.append(x.T @ (wrong[text] * e / z[text]), wrong.sum()) + strength * (w - prior)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return dict(zip(NAMES, map(float, w), strict=False)), float(w[-1])


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from training: crc32 of its id as text; null ids are."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, modulus: int, remainder: int, rows: int, chars: int = TRAIN_CHARS) -> DataFrame:
    """id, label and text of at most rows labelled documents outside the held-out fold, one row an id and none of more than chars characters, written to the shared folder."""
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label is not null").filter(~held_out(F.col("id"), modulus, remainder))
    labelled = usable.groupBy("id").agg(F.max("label").alias("label"))
    # a hash threshold leaves little more than the bound for the ordered limit
    share = min(1.0, 1.3 * rows / max(1, labelled.count()))
    chosen = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("id"), "id").limit(rows)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # at most rows ids, so the broadcast is bounded
    chosen = F.broadcast(materialize(chosen, "chosen", tiny=True))
    found = text.join(chosen, "id").filter(F.coalesce(F.length("text"), F.lit(0)) <= chars)
    if text.select("id").join(chosen, "id").groupBy("id").count().filter("count > 1").limit(1).count():  # one text an id
        found = found.groupBy("id", "label").agg(F.min("text").alias("text"))
    return materialize(found.select("id", "label", "text"), "labelled", compact=True)


def learn_grammar(sample: DataFrame) -> tuple[tuple[str, ...], dict[str, float], float]:
    """Stems, arc weights and bias from id, label, text."""
    ship_package(sample.sparkSession)

    def vocabulary(batches):
        for batch in batches:
            words = [" ".join(sorted(set(_STEM.findall((t or "").lower())))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.string())], names=["label", "words"])

    rows = sample.select("label", "text").mapInArrow(vocabulary, "label int, words string").collect()
    stems = learn_stems([(r["words"], r["label"]) for r in rows])
    del rows

    def measure(batches):
        grammar = Grammar(stems)
        for batch in batches:
            counts = [np.array(grammar.clauses(t)).ravel() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.list_(pa.float64()))], names=["id", "label", "x"])

    id_type = sample.schema["id"].dataType.simpleString()
    measured = sample.select("id", "label", "text").mapInArrow(measure, f"id {id_type}, label int, x array<double>").toArrow().sort_by("id").to_pydict()
    clauses = [np.array(x, float).reshape(-1, len(NAMES)) for x in measured["x"]]
    return stems, *fit(clauses, np.array(measured["label"], float))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", modulus: int = 4, remainder: int = 2, threshold: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row: the id, held_out, score and predicted."""
    stems, weights, bias = learn_grammar(training_sample(docs, labels, id_col, text_col, label_col, modulus, remainder, train_rows))
    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType(), False), T.StructField("score", T.DoubleType(), False)])

    def score(batches):
        grammar = Grammar(stems, weights)
        for batch in batches:
            scores = [text_score(grammar.clauses(t.as_py()), bias) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=schema.names)

    rows = docs.select(F.col(id_col), held_out(F.col(id_col), modulus, remainder).alias("held_out"), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
