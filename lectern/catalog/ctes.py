"""Shared table expressions of the oracle SQL, in dependency order.

Each restates a derived input or an index table in plain SQL, apart from the
Spark code that computes the same thing."""

from __future__ import annotations

from collections.abc import Iterable

# name: (names it reads, select statement)
CTES: dict[str, tuple[str, str]] = {
    "passages": (
        "",
        """SELECT row_number() OVER (ORDER BY first_id NULLS LAST, sha256(text) NULLS FIRST) - 1 AS pid, text
           FROM (SELECT text, min(doc_id) AS first_id FROM documents GROUP BY text)""",
    ),
    "questions": ("", "SELECT item_id AS qid, text AS question FROM benchmark"),
    "ptoks": (
        "passages",
        r"SELECT pid, [x for x in string_split_regex(lower(text), '\s+') if x <> ''] AS toks FROM passages",
    ),
    "qtoks": (
        "questions",
        r"SELECT qid, [x for x in string_split_regex(lower(question), '\s+') if x <> ''] AS toks FROM questions",
    ),
    "postings": (
        "ptoks",
        """SELECT pid, dl, term, count(*) AS tf
           FROM (SELECT pid, len(toks) AS dl, unnest(toks) AS term FROM ptoks) GROUP BY pid, dl, term""",
    ),
    "qterms": (
        "qtoks",
        """SELECT qid, term, count(*) AS qtf
           FROM (SELECT qid, unnest(toks) AS term FROM qtoks) GROUP BY qid, term""",
    ),
    "stats": ("ptoks", "SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM ptoks"),
    "bm25_raw": (
        "postings stats",
        """SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw_idf
           FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), stats""",
    ),
    "bm25_vocab": (
        "bm25_raw",
        """SELECT term, df, CASE WHEN raw_idf < 0 THEN 0.25 * (SELECT avg(raw_idf) FROM bm25_raw)
                                 ELSE raw_idf END AS idf FROM bm25_raw""",
    ),
    "bm25_scores": (
        "postings bm25_vocab qterms stats",
        """SELECT qid, pid, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
           FROM qterms JOIN postings USING (term) JOIN bm25_vocab USING (term), stats
           GROUP BY qid, pid""",
    ),
    "bm25_ranked": (
        "bm25_scores",
        """SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS rank
           FROM bm25_scores""",
    ),
    # unigrams and bigrams
    "grams": (
        "ptoks",
        """SELECT pid, term, count(*) AS tf FROM (
             SELECT pid, unnest(list_concat(toks, [toks[i] || ' ' || toks[i + 1] for i in range(1, len(toks))])) AS term
             FROM ptoks) GROUP BY pid, term""",
    ),
    "qgrams": (
        "qtoks",
        """SELECT qid, term, count(*) AS qtf FROM (
             SELECT qid, unnest(list_concat(toks, [toks[i] || ' ' || toks[i + 1] for i in range(1, len(toks))])) AS term
             FROM qtoks) GROUP BY qid, term""",
    ),
    "vocab": (
        "grams stats",
        """SELECT term, cf, df, ln((1.0 + n) / (1 + df)) + 1 AS idf
           FROM (SELECT term, sum(tf) AS cf, count(*) AS df FROM grams GROUP BY term
                 ORDER BY cf DESC, term LIMIT 50000), stats""",
    ),
    "pweights": (
        "grams vocab",
        """SELECT pid, term, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY pid)) AS w
           FROM grams JOIN vocab USING (term)""",
    ),
    "qweights": (
        "qgrams vocab",
        """SELECT qid, term, qtf * idf / sqrt(sum((qtf * idf) * (qtf * idf)) OVER (PARTITION BY qid)) AS wq
           FROM qgrams JOIN vocab USING (term)""",
    ),
    "tfidf_scores": (
        "pweights qweights",
        """SELECT qid, pid, round(sum(w * wq), 6) AS score
           FROM qweights JOIN pweights USING (term) GROUP BY qid, pid""",
    ),
    "tfidf_ranked": (
        "tfidf_scores",
        """SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS rank
           FROM tfidf_scores""",
    ),
    # question answering examples
    "examples": (
        "passages",
        """SELECT item_id AS id, question, context, instr(context, question) + 39 AS answer_start,
                  substr(question, 41, 20) AS answer
           FROM (SELECT b.item_id, b.text AS question, p.text AS context,
                        row_number() OVER (PARTITION BY b.item_id ORDER BY p.pid) AS n
                 FROM benchmark b JOIN passages p ON contains(p.text, b.text)) WHERE n = 1""",
    ),
    "ex_spans": (
        "examples",
        r"""SELECT id, question, context, answer, answer_start, answer_start + len(answer) AS answer_end,
                   [x for x in string_split_regex(question, '\s+') if x <> ''] AS q,
                   regexp_extract_all(context, '\S+') AS t, regexp_extract_all(context, '\s+') AS sep,
                   CASE WHEN regexp_matches(context, '^\s') THEN 1 ELSE 0 END AS lead
            FROM examples""",
    ),
    "tok_spans": (
        "ex_spans",
        """SELECT id, pos, tok, CAST(e - len(tok) AS BIGINT) AS s, CAST(e AS BIGINT) AS e
           FROM (SELECT id, pos, tok,
                        sum(len(tok) + gap) OVER (PARTITION BY id ORDER BY pos) AS e
                 FROM (SELECT id, unnest(t) AS tok, unnest(range(len(t))) AS pos,
                              unnest([coalesce(len(CASE WHEN i + lead >= 1 THEN sep[i + lead] END), 0)
                                      for i in range(len(t))]) AS gap
                       FROM ex_spans))""",
    ),
    "ex_caps": (
        "ex_spans",
        """SELECT id, len(q) AS nq, len(t) AS nt, 384 - len(q) - 3 AS cap, 384 - len(q) - 3 - 128 AS step
           FROM ex_spans""",
    ),
    "windows": (
        "ex_caps",
        """SELECT id AS example_id, w AS window_no, nq, w * step AS first,
                  least(w * step + cap, nt) - 1 AS last
           FROM (SELECT *, unnest(range(CASE WHEN nt <= cap THEN 1
                        ELSE 1 + CAST(ceil((nt - cap) / step) AS BIGINT) END)) AS w FROM ex_caps)""",
    ),
    # one row per position of a feature: markers and question have no span
    "window_toks": (
        "windows tok_spans",
        """SELECT example_id, window_no, nq + 2 + pos - first AS i, pos, tok, s, e
           FROM windows JOIN tok_spans ON tok_spans.id = example_id AND pos BETWEEN first AND last""",
    ),
    "logits": (
        "windows",
        """SELECT example_id, window_no, i,
                  ((i * 37 + example_id * 101 + window_no * 53) % 1009) / 100.0 - 5 AS start_logit,
                  ((i * 41 + example_id * 211 + window_no * 53) % 1009) / 100.0 - 5 AS end_logit
           FROM (SELECT *, unnest(range(nq + 3 + last - first + 1)) AS i FROM windows)""",
    ),
    "starts": (
        "logits",
        """SELECT * FROM (SELECT example_id, window_no, i AS si, start_logit,
             row_number() OVER (PARTITION BY example_id, window_no ORDER BY start_logit DESC, i) AS n FROM logits)
           WHERE n <= 20""",
    ),
    "ends": (
        "logits",
        """SELECT * FROM (SELECT example_id, window_no, i AS ei, end_logit,
             row_number() OVER (PARTITION BY example_id, window_no ORDER BY end_logit DESC, i) AS n FROM logits)
           WHERE n <= 20""",
    ),
    "spans": (
        "starts ends window_toks examples",
        """SELECT a.example_id, a.window_no, a.si, b.ei, a.start_logit, b.end_logit,
                  round(a.start_logit + b.end_logit, 6) AS score, ws.s AS s, we.e AS e,
                  substr(x.context, ws.s + 1, we.e - ws.s) AS text
           FROM starts a JOIN ends b ON a.example_id = b.example_id AND a.window_no = b.window_no
                AND b.ei BETWEEN a.si AND a.si + 29
           JOIN window_toks ws ON ws.example_id = a.example_id AND ws.window_no = a.window_no AND ws.i = a.si
           JOIN window_toks we ON we.example_id = b.example_id AND we.window_no = b.window_no AND we.i = b.ei
           JOIN examples x ON x.id = a.example_id""",
    ),
    "null_scores": (
        "logits",
        """SELECT example_id, window_no, start_logit, end_logit, score FROM (
             SELECT example_id, window_no, start_logit, end_logit, round(start_logit + end_logit, 6) AS score,
                    row_number() OVER (PARTITION BY example_id
                                       ORDER BY round(start_logit + end_logit, 6), window_no) AS n
             FROM logits WHERE i = 0) WHERE n = 1""",
    ),
    # without null answers
    "nbest": (
        "spans examples",
        """SELECT id AS example_id, coalesce(rank, 1) AS rank, coalesce(text, 'empty') AS text,
                  coalesce(start_logit, 0.0) AS start_logit, coalesce(end_logit, 0.0) AS end_logit,
                  coalesce(score, 0.0) AS score
           FROM examples LEFT JOIN (
             SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, window_no, si, ei) AS rank
             FROM spans) r ON id = example_id AND rank <= 20""",
    ),
    # with the null answer as a candidate, added again when the cut removes it
    "nbest_null": (
        "spans null_scores",
        """SELECT example_id, row_number() OVER (PARTITION BY example_id ORDER BY cut, score DESC, window_no, si, ei) AS rank,
                  text, start_logit, end_logit, score
           FROM (SELECT *, CASE WHEN n <= 20 THEN 0 ELSE 1 END AS cut FROM (
                   SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, window_no, si, ei) AS n
                   FROM (SELECT example_id, window_no, si, ei, text, start_logit, end_logit, score FROM spans
                         UNION ALL
                         SELECT example_id, window_no, -1, -1, '', start_logit, end_logit, score FROM null_scores)))
           WHERE cut = 0 OR si = -1""",
    ),
    # vectors
    "vecs": ("", "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings"),
    "dims": ("vecs", "SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS d FROM vecs"),
    "centroids": (
        "dims",
        """SELECT label AS cell, list(round(m, 6) ORDER BY d) AS c
           FROM (SELECT label, d, avg(x) AS m FROM dims GROUP BY label, d) GROUP BY label""",
    ),
    "cell_distances": (
        "vecs centroids",
        """SELECT vec_id, cell, round(list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, len(v) + 1)]), 6) AS d2
           FROM vecs, centroids""",
    ),
    "cells": (
        "cell_distances",
        """SELECT vec_id, cell, d2 FROM (
             SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cell) AS n FROM cell_distances)
           WHERE n = 1""",
    ),
    "ip_ranked": (
        "vecs",
        """SELECT qid, pid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS rank
           FROM (SELECT a.vec_id AS qid, b.vec_id AS pid, round(list_inner_product(a.v, b.v), 6) AS score
                 FROM vecs a, vecs b)""",
    ),
    # prediction and gold pairs
    "pairs": (
        "",
        r"""SELECT id, words, len(words) AS n, role,
                   CASE WHEN len(words) >= 6 THEN array_to_string(words[5:], ' ') END AS prediction,
                   array_to_string(words[1:greatest(len(words) - 4, 0)], ' ') AS gold1,
                   CASE WHEN role = 'user' THEN array_to_string(words, ' ')
                        ELSE array_to_string(words[3:], ' ') END AS gold2
            FROM (SELECT conv_id * 100 + turn AS id, role,
                         [x for x in string_split_regex(text, '\s+') if x <> ''] AS words FROM conversations)""",
    ),
    "golds": (
        "pairs",
        """SELECT id, 0 AS gold_no, prediction, gold1 AS gold FROM pairs
           UNION ALL SELECT id, 1, prediction, gold2 FROM pairs""",
    ),
    "normal_golds": (
        "golds",
        r"""SELECT id, gold_no, prediction IS NOT NULL AS answered,
              [x for x in string_split_regex(regexp_replace(lower(prediction), '[!-/:-@\[-`{-~]', '', 'g'), '\s+')
               if x not in ('', 'a', 'an', 'the')] AS p,
              [x for x in string_split_regex(regexp_replace(lower(gold), '[!-/:-@\[-`{-~]', '', 'g'), '\s+')
               if x not in ('', 'a', 'an', 'the')] AS g
            FROM golds""",
    ),
    "shared_toks": (
        "normal_golds",
        """SELECT id, gold_no, sum(least(np, ng)) AS same FROM (
             SELECT id, gold_no, tok, count(*) FILTER (WHERE side = 'p') AS np, count(*) FILTER (WHERE side = 'g') AS ng
             FROM (SELECT id, gold_no, 'p' AS side, unnest(p) AS tok FROM normal_golds WHERE answered
                   UNION ALL SELECT id, gold_no, 'g', unnest(g) FROM normal_golds WHERE answered)
             GROUP BY id, gold_no, tok) GROUP BY id, gold_no""",
    ),
    "scored": (
        "normal_golds shared_toks",
        """SELECT n.id, n.gold_no, answered,
                  CASE WHEN answered AND array_to_string(p, ' ') = array_to_string(g, ' ') THEN 1.0 ELSE 0.0 END AS em,
                  CASE WHEN answered AND coalesce(same, 0) > 0
                       THEN 2.0 * (same / len(p)) * (same / len(g)) / (same / len(p) + same / len(g))
                       ELSE 0.0 END AS f1
           FROM normal_golds n LEFT JOIN shared_toks o ON o.id = n.id AND o.gold_no = n.gold_no""",
    ),
}


def with_ctes(body: str, names: Iterable[str]) -> str:
    """``body`` with the named expressions, and all they read, in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in CTES[name][0].split():
                visit(needed)
            if name not in ordered:
                ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in ordered)
    return f"WITH {parts}\n{body}"
