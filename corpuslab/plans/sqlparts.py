"""Common table expressions shared by the checking SQL (DuckDB dialect)."""

from __future__ import annotations

from corpuslab.functions import stem as st
from corpuslab.functions.words import ENGLISH_STOP_WORDS, IRREGULAR_NOUNS, IRREGULAR_VERBS, NOUN_RULES


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOPS = quoted(ENGLISH_STOP_WORDS)

# name -> (names it needs, body)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "sent": (
        (),
        r"""SELECT doc_id, generate_subscripts(s, 1) - 1 AS sent_pos, unnest(s) AS sentence
            FROM (SELECT doc_id, string_split(
                    regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s
                  FROM documents)""",
    ),
    "lettered": (
        ("sent",),
        """SELECT doc_id, sent_pos, list_filter(
                string_split(lower(regexp_replace(sentence, '[^a-zA-Z]', ' ', 'g')), ' '),
                lambda w: w <> '') AS words
           FROM sent WHERE NOT starts_with(sentence, '==')""",
    ),
    "clean": (
        ("lettered",),
        f"""SELECT doc_id, sent_pos, list_filter(words, lambda w: w NOT IN ({STOPS})) AS words
            FROM lettered""",
    ),
    "tok": (("clean",), "SELECT doc_id, unnest(words) AS word FROM clean"),
    "post": (("tok",), "SELECT doc_id, word, count(*) AS n FROM tok GROUP BY doc_id, word"),
    "freq": (
        ("post",),
        "SELECT word, CAST(sum(n) AS BIGINT) AS cf, count(*) AS df FROM post GROUP BY word",
    ),
    "nd": ((), "SELECT count(*) AS n_docs FROM documents"),
    "wv": (
        ("freq",),
        """SELECT word, vec_id, CAST(embedding AS DOUBLE[]) AS vector
           FROM (SELECT word, row_number() OVER (ORDER BY df DESC, word) - 1 AS r FROM freq)
           JOIN embeddings ON vec_id = r""",
    ),
    "wv_long": (
        ("wv",),
        """SELECT word, generate_subscripts(vector, 1) - 1 AS dim, unnest(vector) AS v FROM wv""",
    ),
    "dims": ((), "SELECT DISTINCT unnest(range(len(embedding))) AS dim FROM embeddings"),
    "known": (
        ("post", "wv"),
        """SELECT d.doc_id, coalesce(sum(CASE WHEN wv.word IS NOT NULL THEN p.n END), 0) AS known,
                  coalesce(sum(p.n), 0) AS total
           FROM documents d LEFT JOIN post p ON p.doc_id = d.doc_id
           LEFT JOIN wv ON wv.word = p.word GROUP BY d.doc_id""",
    ),
    "docvec": (
        ("known", "wv_long", "dims"),
        """SELECT k.doc_id, dims.dim, coalesce(s.total / nullif(k.known, 0), 0.0) AS value
           FROM known k CROSS JOIN dims
           LEFT JOIN (SELECT p.doc_id, w.dim, sum(p.n * w.v) AS total
                      FROM post p JOIN wv_long w ON w.word = p.word GROUP BY p.doc_id, w.dim) s
             ON s.doc_id = k.doc_id AND s.dim = dims.dim""",
    ),
    "singles": (("tok",), "SELECT word, count(*) AS n FROM tok GROUP BY word"),
    "pairs": (
        ("clean",),
        """SELECT a AS first, b AS second, count(*) AS n
           FROM (SELECT unnest(list_zip(words[1:len(words) - 1], words[2:])) AS p FROM clean
                 WHERE len(words) > 1) t, LATERAL (SELECT p[1] AS a, p[2] AS b)
           GROUP BY 1, 2""",
    ),
    "phrases": (
        ("singles", "pairs"),
        """SELECT p.first, p.second, p.n,
                  (p.n - 5) / a.n / b.n
                  * ((SELECT count(*) FROM singles) + (SELECT count(*) FROM pairs)) AS score
           FROM pairs p JOIN singles a ON a.word = p.first JOIN singles b ON b.word = p.second
           WHERE p.n > 5""",
    ),
}


def parts(*names: str, extra: str = "") -> str:
    """WITH clause for the named parts and what they need, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in PARTS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    listed = [f"{name} AS ({PARTS[name][1]})" for name in ordered]
    if extra:
        listed.append(extra)
    return "WITH " + ",\n".join(listed) + "\n"


def stem_parts(source: str, word: str = "word") -> str:
    """CTEs that end in ``stems`` (word, stem) over the distinct words of ``source``."""

    def cut(n: int) -> str:
        return f"substr(w, 1, length(w) - {n})"

    def matches(expr: str, pattern: str) -> str:
        return f"regexp_matches({expr}, '{pattern}')"

    def suffix_step(rules: dict[str, str], test: str) -> str:
        whens = []
        for s in sorted(rules, key=len, reverse=True):
            condition = matches(cut(len(s)), test)
            if s == "ion":
                condition += " AND " + matches(cut(3), "[st]$")
            whens.append(
                f"WHEN ends_with(w, '{s}') THEN CASE WHEN {condition} THEN {cut(len(s))} || '{rules[s]}' ELSE w END"
            )
        return "CASE " + " ".join(whens) + " ELSE w END"

    stem1 = "substr(w, 1, length(w) - 1)"
    double = (
        "length({0}) > 1 AND right({0}, 1) = left(right({0}, 2), 1)"
        " AND NOT regexp_matches(right({0}, 1), '[aeiouy]')"
    ).format(stem1)
    steps = [
        "regexp_replace(regexp_replace(regexp_replace(w, '^y', 'Y'), '([aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')",
        f"CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {cut(2)} WHEN ends_with(w, 'ss') THEN w"
        f" WHEN ends_with(w, 's') THEN {cut(1)} ELSE w END",
        f"CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {matches(cut(3), st.M_ABOVE_0)} THEN {cut(1)} ELSE w END"
        f" WHEN ends_with(w, 'ed') AND {matches(cut(2), '[aeiouy]')} THEN {cut(2)} || '|'"
        f" WHEN ends_with(w, 'ing') AND {matches(cut(3), '[aeiouy]')} THEN {cut(3)} || '|' ELSE w END",
        f"CASE WHEN NOT ends_with(w, '|') THEN w"
        f" WHEN {matches(stem1, '(at|bl|iz)$')} THEN {stem1} || 'e'"
        f" WHEN {double} AND NOT {matches(stem1, '[lsz]$')} THEN substr(w, 1, length(w) - 2)"
        f" WHEN {matches(stem1, st.M_EQUALS_1)} AND {matches(stem1, st.ENDS_CVC)} THEN {stem1} || 'e'"
        f" ELSE {stem1} END",
        f"CASE WHEN {matches('w', '[yY]$')} AND {matches(stem1, '[aeiouy]')} THEN {stem1} || 'i' ELSE w END",
        suffix_step(st.STEP_2, st.M_ABOVE_0),
        suffix_step(st.STEP_3, st.M_ABOVE_0),
        suffix_step({s: "" for s in st.STEP_4}, st.M_ABOVE_1),
        f"CASE WHEN ends_with(w, 'e') AND ({matches(stem1, st.M_ABOVE_1)} OR ({matches(stem1, st.M_EQUALS_1)}"
        f" AND NOT {matches(stem1, st.ENDS_CVC)})) THEN {stem1} ELSE w END",
        f"CASE WHEN ends_with(w, 'll') AND {matches(stem1, st.M_ABOVE_1)} THEN {stem1} ELSE w END",
    ]
    ctes = [f"st0 AS (SELECT DISTINCT {word} AS word, {word} AS w FROM {source} WHERE length({word}) > 2)"]
    for i, step in enumerate(steps):
        ctes.append(f"st{i + 1} AS (SELECT word, {step} AS w FROM st{i})")
    ctes.append(
        f"stems AS (SELECT word, lower(w) AS stem FROM st{len(steps)}"
        f" UNION ALL SELECT DISTINCT {word}, {word} FROM {source} WHERE length({word}) <= 2)"
    )
    return ",\n".join(ctes)


def lemma_parts(source: str, rules=NOUN_RULES, lexicon: str = "lw") -> str:
    """CTEs that end in ``lemmas`` (word, lemma): irregular forms, then the given rules, corpus words as lexicon."""
    irregular = IRREGULAR_NOUNS if rules is NOUN_RULES else IRREGULAR_VERBS
    forms = ", ".join(f"('{a}', '{b}')" for a, b in irregular.items())
    options = ["SELECT word, 0 AS rule, word AS candidate FROM lw"]
    for i, (suffix, replacement) in enumerate(rules, start=1):
        options.append(
            f"SELECT word, {i}, substr(word, 1, length(word) - {len(suffix)}) || '{replacement}' FROM lw"
            f" WHERE ends_with(word, '{suffix}')"
        )
    return (
        f"lw AS (SELECT DISTINCT word FROM {source}),\n"
        f"lc AS ({' UNION ALL '.join(options)}),\n"
        f"irr AS (SELECT * FROM (VALUES {forms}) AS t(word, lemma)),\n"
        "lemmas AS (SELECT word, candidate AS lemma FROM (SELECT word, candidate, row_number() OVER"
        " (PARTITION BY word ORDER BY length(candidate), rule, candidate) AS r"
        f" FROM lc WHERE candidate IN (SELECT word FROM {lexicon}) AND word NOT IN (SELECT word FROM irr)) WHERE r = 1"
        " UNION ALL SELECT word, lemma FROM irr WHERE word IN (SELECT word FROM lw))"
    )
