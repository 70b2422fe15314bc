"""Line-first quality rules (operator 1), in built-in functions only.

Each line with a word is held against the rules below; failing lines are removed,
and a document that loses too much of its text is rejected, as is one that fails
the base limits. Lines are only looked at one by one in texts that hold a sign of
any rule at all. Repeats are found inside the row: a text whose hashes of 3-word
windows are all distinct has none, and only the others are sorted and looked at
by position. Nothing is shuffled.

Null, empty and blank texts have no words and are rejected; an empty table gives
an empty result. Texts of any length are judged whole, inside their row. Every
row is judged by itself, so repeated rows get equal results; there are no ties.
All columns pass through untouched beside one struct column of the outcome, and
a name that is taken is an error. Only the text is read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.native import WORD, count_symbols, count_words, let, words

#: Symbols a word of a line that are too many.
SYMBOLS_A_WORD = 0.3
#: Runs of two or more exclamation or question marks a word of a line that are too many.
SHOUTS = 0.3
#: Separators a line at least, and words between them at most, that make a menu.
MENU_BARS, MENU_WORDS = 3, 3
#: Least share of the words that cleaned lines must keep.
LEAST_KEPT = 0.5

#: Phrases of page furniture in English, German, French and Spanish, matched in lower case.
BOILERPLATE = (
    "accept all cookies", "this site uses cookies", "we use cookies", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "all rights reserved", "enable javascript", "javascript is disabled", "click here to", "sign up for our newsletter",
    "subscribe to our newsletter", "lorem ipsum", "skip to content", "skip to main content", "share on facebook", "share on twitter",
    "alle cookies akzeptieren", "website verwendet cookies", "wir verwenden cookies", "alle rechte vorbehalten", "nutzungsbedingungen",
    "datenschutzerklärung", "zum inhalt springen", "newsletter abonnieren", "javascript aktivieren", "auf facebook teilen",
    "accepter tous les cookies", "site utilise des cookies", "nous utilisons des cookies", "tous droits réservés", "conditions d'utilisation",
    "politique de confidentialité", "mentions légales", "aller au contenu", "activer javascript", "partager sur facebook",
    "aceptar todas las cookies", "sitio utiliza cookies", "utilizamos cookies", "todos los derechos reservados", "condiciones de uso",
    "política de privacidad", "aviso legal", "saltar al contenido", "activar javascript", "compartir en facebook",
)
#: A piece of every phrase: a text without any of them is not searched for phrases line by line.
PHRASE_SIGNS = (
    "cookie", "javascript", "newsletter", "facebook", "rights reserved", "privacy policy", "terms of ", "click here to", "lorem ipsum", "skip to ", "share on ",
    "rechte vorbehalten", "nutzungsbedingungen", "datenschutzerkl", "zum inhalt", "droits r", "conditions d'ut", "confidentialit", "mentions l", "aller au contenu",
    "derechos reservados", "condiciones de uso", "de privacidad", "aviso legal", "saltar al contenido",
)
#: Entries of navigation bars in the four languages; a short line of only these is one.
NAVIGATION_WORDS = (
    "home|menu|login|log in|sign in|sign up|register|search|about|about us|contact|contact us|next|previous|prev|back|top|faq|help|sitemap|read more|more|share|print"
    "|startseite|menü|anmelden|registrieren|suche|über uns|kontakt|weiter|zurück|hilfe|mehr|teilen|drucken"
    "|accueil|connexion|inscription|recherche|à propos|suivant|précédent|retour|aide|plan du site|lire la suite|partager|imprimer"
    "|inicio|menú|iniciar sesión|registrarse|buscar|sobre nosotros|contacto|siguiente|anterior|volver|ayuda|mapa del sitio|leer más|compartir|imprimir"
)
NAVIGATION = rf"^(?:(?:{NAVIGATION_WORDS})(?:[\s|>»·/,-]+|$))+$"
#: The same for Java, which runs a plain repeated group by recursion and its stack out on a long line: a possessive group, with longer entries first since it never goes back.
_ENTRIES = "|".join(sorted(NAVIGATION_WORDS.split("|"), key=len, reverse=True))
_NAVIGATION = rf"^(?:(?:{_ENTRIES})(?:[\s|>»·/,-]+|$))++$"
_SIGNS = r"[#*$%&|<>»·]|[!?]{2}"
_SHOUT = r"[!?]{2,}"
_BAR = r"[\x20\x09][|>»·][\x20\x09]"


def repeated_window_words(tokens: Column) -> Column:
    """Words that lie in a window of three that the text has twice or more."""
    hashes = lambda v: F.transform(F.sequence(F.lit(0), F.size(v) - 3), lambda i: F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        at = let(pairs, lambda p: F.sort_array(F.transform(F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])), lambda x: x["i"])))
        # a window starting at a covers up to the next repeated window's start, three words at most
        return let(at, lambda a: F.aggregate(F.transform(a, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(a, i + 1), x + 3) - x)), F.lit(0), lambda acc, x: acc + x))

    counted = let(hashes(tokens), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(tokens) < 4, F.lit(0)).otherwise(counted).cast("long")


def line_fails(line: Column) -> Column:
    """Whether a line with a word fails one of the rules; costly counts come after cheap signs."""

    def judge(v: Column) -> Column:
        lower, n = v["lower"], v["n"]
        punctuation = line.rlike(r"[#*$%&|<>]") & (count_symbols(line) > SYMBOLS_A_WORD * n) | line.rlike(r"[!?]{2}") & (F.regexp_count(line, F.lit(_SHOUT)) > SHOUTS * n)
        menu = line.rlike(r"[|>»·]") & let(F.regexp_count(line, F.lit(_BAR)), lambda bars: (bars >= MENU_BARS) & (n <= (bars + 1) * (MENU_WORDS + 1)))
        return punctuation | menu | (n <= 12) & lower.rlike(_NAVIGATION) | has_phrase(lower)

    return let(F.struct(F.lower(line).alias("lower"), F.regexp_count(line, F.lit(WORD)).alias("n")), judge)


def has_phrase(lower: Column) -> Column:
    return reduce(or_, (lower.contains(p) for p in BOILERPLATE))


def may_fail(text: Column) -> Column:
    """Holds for every text with a failing line; most clean texts end here."""
    return text.rlike(_SIGNS) | let(F.lower(text), lambda v: reduce(or_, (v.contains(s) for s in PHRASE_SIGNS)) | v.rlike(rf"(?m)^(?:{NAVIGATION_WORDS})"))


def clean_lines(text: Column) -> Column:
    """The text without failing lines; blank lines stay. A text without failing lines comes back as it is."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda s: ~(s.rlike(r"[^\x20\x09-\x0D]") & line_fails(s))), "\n")


def judgement(text: Column, least_words: int, most_repeats: int, least_kept: float) -> Column:
    """All outcomes of one text as a struct."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lined = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_window_words(w).alias("n_repeat_words")))
    cleaned = F.when(may_fail(text), let(clean_lines(text), lambda c: F.struct(c.alias("text"), count_words(c).alias("n"))))
    repeated_lines = let(lined, lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long")

    def verdict(j: Column) -> Column:
        n = j["c"]["n_words"]
        kept_words = F.coalesce(j["cleaned"]["n"], n)
        failed = (n < least_words) | (100 * j["c"]["n_repeat_words"] > most_repeats * n)
        return F.struct(
            n.alias("n_words"), j["c"]["word_chars"].alias("word_chars"), j["n_symbols"].alias("n_symbols"), j["n_dup_lines"].alias("n_dup_lines"), j["c"]["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"), (~failed & (kept_words >= least_kept * n)).alias("kept"), kept_words.alias("kept_words"), F.coalesce(j["cleaned"]["text"], text).alias("clean_text"),
        )

    return let(F.struct(counts.alias("c"), count_symbols(text).alias("n_symbols"), repeated_lines.alias("n_dup_lines"), cleaned.alias("cleaned")), verdict)


def quality_rules(docs: DataFrame, text_col: str = "text", into: str = "quality", least_words: int = 50, most_repeats: int = 50, least_kept: float = LEAST_KEPT) -> DataFrame:
    """docs with one more column, a struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, kept_words and clean_text."""
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs already has a column {into}")
    # a generated column is computed once, however many filters and columns are taken from it
    return docs.withColumn(into, F.explode(F.array(judgement(F.col(text_col), least_words, most_repeats, least_kept))))


_PHRASES = "|".join(BOILERPLATE).replace("'", "''")
QUALITY_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
pos AS (SELECT rid, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w WHERE len(ws) >= 3),
win AS (SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM pos),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
ls AS (SELECT rid, unnest(string_split(t, chr(10))) AS s FROM d),
ln AS (SELECT rid, s, lower(s) AS lo, len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) AS n,
  len(s) - len(regexp_replace(s, '[#*$%&|<>]', '', 'g')) AS sy,
  len(regexp_extract_all(s, '{_SHOUT}')) AS sh, len(regexp_extract_all(s, '[\\x20\\x09][|>»·][\\x20\\x09]')) AS bars
  FROM ls WHERE regexp_matches(s, '[^\\x20\\x09-\\x0D]')),
lf AS (SELECT rid, s, n, (sy > {SYMBOLS_A_WORD} * n OR sh > {SHOUTS} * n OR (bars >= {MENU_BARS} AND n <= (bars + 1) * {MENU_WORDS + 1})
  OR (n <= 12 AND regexp_matches(lo, '{NAVIGATION}')) OR regexp_matches(lo, '{_PHRASES}')) AS bad FROM ln),
la AS (SELECT rid, count(*) - count(DISTINCT s) AS dups, coalesce(sum(n) FILTER (NOT bad), 0) AS kw FROM lf GROUP BY rid),
j AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
  (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines,
  coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(kw, 0)::BIGINT AS kept_words
  FROM w LEFT JOIN cov USING (rid) LEFT JOIN la USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND kept_words >= {LEAST_KEPT} * n_words AS kept, kept_words FROM b
"""
