"""Line-first quality rules, in Spark SQL functions only.

Each line of a text is judged alone: a line of prose ends in sentence punctuation
(or is too short to need it) and isn't strewn with symbols, a navigation line is a row of labels with separators
between them, a boilerplate line has one of a few site phrases. Lines that fail go;
a document that loses more than max_loss percent of its characters in words by
that, or fails the base rules, is rejected.

Defined cases: null text is empty; an empty text has no words and fails the base
rules; repeated rows are judged alike, so there are no ties; input columns named like
a result column are replaced; an empty table gives no rows; a line or text of any
length is judged whole, in time n log n and without recursion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT = 50
MAX_LOSS = 50
#: A line of so many words or more has to end like a sentence.
PROSE_WORDS = 12

SPACE = r"\x20\x09-\x0D"
#: The same as an SQL string.
WHITE = r"' \t\n\u000B\u000C\r'"
#: What may stand at the end of a line of prose: sentence ends, then closing quotes and brackets.
ENDS = r'[.!?:;,…。！？]["\x27)\]»“”’]*[\x20\x09-\x0D]*$'
#: Label separators of menus, how many a menu has at least, and how long its labels are at most.
SEPARATORS, LABELS, LABEL_CHARS = "|»›>•·", 3, 30
#: Runs of symbols; a line with one for every NOISE_WORDS words isn't prose.
NOISE, NOISE_WORDS = r"[#$%&*]{2,}", 4
#: Site phrases in English, German, French and Spanish, at the start of a word.
BOILERPLATE = (
    r"(?i)(^|[^a-z])(all rights reserved|privacy policy|terms of (use|service)|cookie (policy|settings)|uses cookies|accept (all )?cookies"
    r"|enable javascript|javascript is (disabled|required)|lorem ipsum|click here to|sign up for our|subscribe to our|skip to (main )?content"
    r"|(log|sign) in to (comment|continue)|share (this )?on (facebook|twitter)"
    r"|alle rechte vorbehalten|datenschutzerkl|nutzungsbedingungen|verwendet cookies|alle cookies akzeptieren|javascript aktivieren|zum inhalt springen|newsletter abonnieren"
    r"|tous droits r|politique de confidentialit|conditions d.utilisation|utilise des cookies|accepter (tous )?les cookies|activer javascript|aller au contenu|se connecter pour"
    r"|todos los derechos reservados|pol.tica de privacidad|condiciones de uso|utiliza cookies|aceptar (todas )?las cookies|activar javascript|ir al contenido|iniciar sesi.n para)"
)
OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text", "n_lines_failed")


def let(name: str, value: str, body: str) -> str:
    """body with name standing for value, which is computed once; Spark may inline a column into each use."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeated_words(words: str) -> str:
    """Words in windows of three that are found twice or more. Sorted window hashes bring equal ones side by side: n log n for any text."""
    windows = f"transform(sequence(0, size({words}) - 3), i -> struct(xxhash64({words}[i], {words}[i + 1], {words}[i + 2]) as h, i as i))"
    twice = "filter(sequence(0, size(s) - 1), k -> coalesce(s[k].h = get(s, k - 1).h, false) or coalesce(s[k].h = get(s, k + 1).h, false))"
    starts = let("s", f"sort_array({windows})", f"array_sort(transform({twice}, k -> s[k].i), (a, b) -> a - b)")
    covered = f"aggregate({starts}, struct(-9 as last, 0 as n), (a, p) -> struct(p as last, a.n + least(3, p - a.last) as n), a -> a.n)"
    return f"if(size({words}) < 3, 0, {covered})"


def menu(line: str) -> str:
    """Labels with separators between them. They are split, since a repeated group of java.util.regex recurses for every label."""
    bare = rf"length(trim(leading {WHITE} from y)) <= {LABEL_CHARS}"
    labels = let("p", f"split({line}, '[{SEPARATORS}]', -1)", f"size(p) > {LABELS} and length(p[0]) > 0 and forall(p, y -> {bare})")
    return f"(length({line}) - length(translate({line}, '{SEPARATORS}', '')) >= {LABELS} and {labels})"


def line_fails(line: str) -> str:
    judged = rf"(n >= {PROSE_WORDS} and not {line} rlike r'{ENDS}') or {NOISE_WORDS} * regexp_count({line}, r'{NOISE}') >= n or {menu(line)} or {line} rlike r'{BOILERPLATE}'"
    return let("n", rf"regexp_count({line}, r'[^{SPACE}]+')", judged)


def quality(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT, max_loss: int = MAX_LOSS) -> DataFrame:
    """docs with the counts, the verdict, and clean_text: the lines that pass."""
    new = set(OUT)
    kept = [c for c in docs.columns if c.lower() not in new]
    named = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__t"))
    counts = let(
        "w",
        rf"filter(split(__t, r'[{SPACE}]+', -1), x -> x <> '')",
        f"named_struct('n_words', cast(size(w) as long), 'n_repeat_words', cast({repeated_words('w')} as long))",
    )
    lines = let(
        "l",
        rf"filter(split(__t, '\n', -1), x -> x rlike r'[^{SPACE}]')",
        f"named_struct('dup', cast(size(l) - size(array_distinct(l)) as long), 'all', size(l), 'good', filter(l, x -> not {line_fails('x')}))",
    )
    chars = lambda x: rf"cast(length(translate({x}, {WHITE}, '')) as long)"
    measured = named.select(
        *[F.col(f"`{c}`") for c in kept],
        F.expr(counts).alias("__c"),
        F.expr(lines).alias("__l"),
        F.expr(chars("__t")).alias("word_chars"),
        F.expr("cast(length(__t) - length(translate(__t, '#*$%&|<>', '')) as long)").alias("n_symbols"),
    )
    cleaned = measured.withColumn("clean_text", F.expr(r"array_join(__l.good, '\n')")).withColumn(
        "base_failed", F.expr(f"__c.n_words < {min_words} or 100 * __c.n_repeat_words > {max_repeat} * __c.n_words")
    )
    passed = F.expr(f"not base_failed and 100 * {chars('clean_text')} >= {100 - max_loss} * word_chars")
    return cleaned.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__c.n_words").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("__l.dup").alias("n_dup_lines"),
        F.col("__c.n_repeat_words").alias("n_repeat_words"),
        "base_failed",
        passed.alias("kept"),
        "clean_text",
        F.expr("cast(__l.all - size(__l.good) as long)").alias("n_lines_failed"),
    )
