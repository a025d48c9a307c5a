"""Line-first cleaning: judge lines, drop failures, then judge what is left.

Every line is tested by itself for symbols, shouting, navigation, boilerplate
and stuttering.  Failed lines are removed, and a document is rejected when they
hold too large a share of its text.  All of it is column expressions over the
text of a row: no row is multiplied and nothing is shuffled, so neither a large
group of copies nor a source with a third of all rows matters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]"
WINDOW = 8
# A word three times or more in a row, and two capitals side by side.
STUTTER = r"(?<![^\x20\n])([^\x20\n]++)(?:\x20++\1(?![^\x20\n])){2,}+"
CAPITALS = r"\p{Lu}{2}"
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

# Wording of lines that say nothing of a document's own, in English,
# German, French and Spanish.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "privacy policy",
    "cookie policy", "accept cookies", "subscribe to our", "sign up for", "click here",
    "read more", "powered by", "skip to content", "enable javascript", "lorem ipsum",
    "permission is hereby granted",
    "alle rechte vorbehalten", "allgemeine geschäftsbedingungen", "datenschutzerklärung",
    "cookies akzeptieren", "newsletter abonnieren", "hier klicken", "zum inhalt springen",
    "javascript aktivieren",
    "tous droits réservés", "conditions d'utilisation", "politique de confidentialité",
    "accepter les cookies", "abonnez-vous à", "cliquez ici", "aller au contenu",
    "activer javascript",
    "todos los derechos reservados", "condiciones de uso", "política de privacidad",
    "aceptar las cookies", "suscríbete a", "haga clic aquí", "saltar al contenido",
    "habilitar javascript",
)
# Words of menus in the same languages.
NAVIGATION = (
    "home", "about", "contact", "login", "logout", "register", "search", "help", "faq", "blog",
    "news", "products", "services", "sitemap", "menu", "cart", "next", "previous",
    "startseite", "kontakt", "impressum", "anmelden", "suche", "hilfe", "produkte", "warenkorb",
    "accueil", "connexion", "recherche", "aide", "produits", "panier", "suivant",
    "inicio", "contacto", "buscar", "ayuda", "productos", "carrito", "siguiente",
)
_MENU = f"(?:{'|'.join(NAVIGATION)})"
MENU_WORD = rf"(?iu)(?<!\p{{L}}){_MENU}(?!\p{{L}})"
# Two of them side by side: a line with more than two thirds of such words has that.
MENU_PAIR = rf"(?iu)(?<!\p{{L}}){_MENU}[^\p{{L}}\n]++{_MENU}(?!\p{{L}})"
# A line of prose ends so, whatever quotes or brackets follow.
ENDED = r"[.!?…:;][\p{Pe}\p{Pf}\x22\x27]*[\x20\t\r]*$"


@dataclass(frozen=True)
class LineLimits:
    """What makes a line fail, as shares of its words, and how much may be lost."""

    symbols: float = 0.5
    separators: float = 0.2
    exclaimed: float = 0.5
    stuttered: float = 0.4
    menu: float = 2 / 3
    lost: float = 0.5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_words(text: Column) -> Column:
    """Words between ASCII blanks; an empty array where there is none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"{BLANK}+")).otherwise(none)


def hits(text: Column, pattern: str) -> Column:
    """Characters that a one-character pattern matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _joined(hashed: Column, step: int) -> Column:
    """Hashes of runs twice as long, from those of runs of ``step`` words."""
    ahead = F.greatest(F.size(hashed) - step, F.lit(0))
    return F.zip_with(
        F.slice(hashed, F.lit(1), ahead),
        F.slice(hashed, F.lit(step + 1), ahead),
        lambda a, b: F.xxhash64(a, b),
    )


def _window_hashes(words: Column) -> Column:
    """64-bit hash of each window of eight words: of pairs, then fours, then eights."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    pairs = let(hashed, lambda h: _joined(h, 1))
    fours = let(pairs, lambda h: _joined(h, 2))
    return let(fours, lambda h: _joined(h, 4))


def _covered(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more.

    Sorting (hash, position) brings equal windows together.  The positions of
    repeated ones, sorted, cover up to the next one or eight words each.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = let(
        placed,
        lambda s: F.transform(
            F.filter(
                s,
                lambda e, k: (
                    (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"])
                ),
            ),
            lambda e: e["i"],
        ),
    )
    steps = let(
        F.sort_array(repeated),
        lambda p: F.transform(
            p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW)))
        ),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)


def word_counts(docs: DataFrame) -> DataFrame:
    """Per document n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Returns the columns of ``docs`` and these (long); NULL and empty texts
    count 0.  ``n_repeat_words`` compares windows by 64-bit hashes: two
    different ones of a text pass for equal with a chance of 2^-64 a pair.
    """
    lines = F.filter(F.split("__text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    staged = (
        docs.withColumn("__text", F.coalesce("text", F.lit("")))
        .withColumns({"__words": split_words(F.col("__text")), "__lines": lines})
        .withColumn("__windows", _window_hashes(F.col("__words")))
    )
    unique = F.size(F.array_distinct("__windows")) == F.size("__windows")
    return staged.select(
        *docs.columns,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        hits(F.col("__text"), r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(unique, F.lit(0).cast("long"))
        .otherwise(_covered(F.col("__windows")))
        .alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def _says_boilerplate(text: Column) -> Column:
    return let(
        F.lower(text),
        lambda said: reduce(Column.__or__, (F.contains(said, F.lit(p)) for p in BOILERPLATE)),
    )


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _is_menu(line: Column, limits: LineLimits) -> Column:
    """Three words or more, nearly all of menus, without punctuation at the end."""
    words = _count(line, r"\p{L}++")
    named = _count(line, MENU_WORD)
    return line.rlike(MENU_PAIR) & ~line.rlike(ENDED) & (words >= 3) & (named > limits.menu * words)


def line_fails(line: Column, limits: LineLimits = LineLimits()) -> Column:
    """Whether a line breaks a rule.

    Boilerplate fails by its wording; lines of three words or more also fail
    by too many symbols, separators or exclamation marks for their words, by
    having capitals only, by words said three times or more in a row, or as
    menus: words of navigation without punctuation at the end.
    """

    def judge(words: Column) -> Column:
        n = F.size(words)
        stuttered = F.length(line) - F.length(F.regexp_replace(line, STUTTER, ""))
        return (n >= 3) & (
            (hits(line, r"[#*$%&<>]") > limits.symbols * n)
            | (hits(line, r"[|»›•]") > limits.separators * n)
            | (hits(line, r"!") > limits.exclaimed * n)
            | ((line == F.upper(line)) & line.rlike(CAPITALS))
            | (stuttered > limits.stuttered * F.length(line))
        )

    return _says_boilerplate(line) | let(split_words(line), judge) | _is_menu(line, limits)


def clean_lines(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """``docs`` with cleaned_text, n_failed_lines, lost_share and rules_kept.

    ``cleaned_text`` has the lines that pass, in order.  ``rules_kept`` is
    false where failed lines hold more than ``limits.lost`` of the characters
    in lines.  NULL and empty texts lose nothing and give an empty text.

    A text without any sign that a rule looks for has no failing line, so its
    lines are not looked at one by one.
    """
    text = F.col("__text")
    signs = text.rlike(r"[#*$%&<>|»›•!]") | text.rlike(CAPITALS) | text.rlike(STUTTER)
    signs = signs | text.rlike(MENU_PAIR)
    lines = F.split("__text", "\n", -1)
    tested = F.transform(
        lines, lambda x: F.struct(x.alias("line"), line_fails(x, limits).alias("fails"))
    )
    judged = (
        docs.withColumn("__text", F.coalesce("text", F.lit("")))
        .withColumn("__signs", signs | _says_boilerplate(text))
        .withColumn("__judged", F.when(F.col("__signs"), tested))
    )

    def part(fails: bool) -> Column:
        chosen = F.filter("__judged", lambda x: x["fails"] if fails else ~x["fails"])
        return F.transform(chosen, lambda x: x["line"])

    staged = judged.withColumns({"__passed": part(False), "__failed": part(True)})
    lost = F.length(F.array_join("__failed", ""))
    share = lost / F.greatest(lost + F.length(F.array_join("__passed", "")), F.lit(1))
    share = F.when(F.col("__signs"), share).otherwise(0.0)
    return staged.select(
        *docs.columns,
        F.when(F.col("__signs"), F.array_join("__passed", "\n"))
        .otherwise(text)
        .alias("cleaned_text"),
        F.when(F.col("__signs"), F.size("__failed"))
        .otherwise(0)
        .cast("long")
        .alias("n_failed_lines"),
        share.alias("lost_share"),
        (share <= limits.lost).alias("rules_kept"),
    )


def judge(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Counts, line rules and the verdict ``kept`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out, and
    repeated rows are judged each.
    """
    counted = word_counts(docs.select("doc_id", "text"))
    return (
        clean_lines(counted, limits)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.col("rules_kept"))
        .drop("text")
    )


def keep_clean(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """The rows of ``docs`` that are kept, without the lines that fail.

    ``text`` is the cleaned text; all other columns, whatever their names, stay
    as they are.  NULL and empty texts have too few words and go, and repeated
    rows are judged each.  A kept text may have fewer than the least number of
    words after cleaning: its own verdict counts, which is about the whole text.
    """
    others = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c != "text"]
    narrow = docs.select("text", F.struct(F.lit(0).alias("__"), *others).alias("__row"))
    # The partition's number keeps Catalyst from writing the verdict's whole
    # expression into the filter once more for every use of its parts.
    judged = clean_lines(word_counts(narrow), limits).select(
        "cleaned_text",
        "__row",
        (~base_failed() & F.col("rules_kept")).alias("__kept"),
        F.spark_partition_id().alias("__part"),
    )
    kept = judged.where(F.col("__kept") & (F.col("__part") >= 0))
    return kept.select(
        *(
            F.col("cleaned_text").alias("text") if c == "text" else F.col("__row").getField(c).alias(c)
            for c in docs.columns
        )
    )
