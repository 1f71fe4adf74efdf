"""The queries once more as plain SQL for an independent engine.

Nothing here is generated from the Spark operators: the survey is derived from
``orders`` by its own arithmetic, scores come from the long form, quantiles and
ranks from built-in functions over all rows. Percentages and means of integers are
rounded half-up in exact integer arithmetic.
"""

from __future__ import annotations

from typing import NamedTuple

# The published questionnaire and data catalogue, written down here
# independently of the operators. Item, trait, wording, reversed.
QUESTIONS = [
    ("M1", "Maquiavelismo", "It's not wise to tell your secrets.", False),
    ("M2", "Maquiavelismo", "I like to use clever manipulation to get my way.", False),
    ("M3", "Maquiavelismo", "Whatever it takes, you must get the important people on your side.", False),
    ("M4", "Maquiavelismo", "Avoid direct conflict with others because they may be useful in the future.", False),
    ("M5", "Maquiavelismo", "It's wise to keep track of information that you can use against people later.", False),
    ("M6", "Maquiavelismo", "You should wait for the right time to get back at people.", False),
    ("M7", "Maquiavelismo", "There are things you should hide from other people because they don't need to know.", False),
    ("M8", "Maquiavelismo", "Make sure your plans benefit you, not others.", False),
    ("M9", "Maquiavelismo", "Most people can be manipulated.", False),
    ("N1", "Narcisismo", "People see me as a natural leader.", False),
    ("N2", "Narcisismo", "I hate being the center of attention.", True),
    ("N3", "Narcisismo", "Many group activities tend to be dull without me.", False),
    ("N4", "Narcisismo", "I know that I am special because everyone keeps telling me so.", False),
    ("N5", "Narcisismo", "I like to get acquainted with important people.", False),
    ("N6", "Narcisismo", "I feel embarrassed if someone compliments me.", True),
    ("N7", "Narcisismo", "I have been compared to famous people.", False),
    ("N8", "Narcisismo", "I am an average person.", True),
    ("N9", "Narcisismo", "I insist on getting the respect I deserve.", False),
    ("P1", "Psicopatia", "I like to get revenge on authorities.", False),
    ("P2", "Psicopatia", "I avoid dangerous situations.", True),
    ("P3", "Psicopatia", "Payback needs to be quick and nasty.", False),
    ("P4", "Psicopatia", "People often say I'm out of control.", False),
    ("P5", "Psicopatia", "It's true that I can be mean to others.", False),
    ("P6", "Psicopatia", "People who mess with me always regret it.", False),
    ("P7", "Psicopatia", "I have never gotten into trouble with the law.", True),
    ("P8", "Psicopatia", "I enjoy having sex with people I hardly know.", False),
    ("P9", "Psicopatia", "I'll say anything to get what I want.", False),
]
PROFILES = [
    "Nenhum traço elevado", "Apenas psicopatia", "Apenas narcisismo",
    "Narcisismo + psicopatia", "Apenas maquiavelismo", "Maquiavelismo + psicopatia",
    "Maquiavelismo + narcisismo", "Tríade completa",
]
TABLE_NOTES = {
    "dim_item": "What each question asks, which trait it counts for and in which direction.",
    "dim_respondente": "Who answered: place and route of access, with the route spelled out.",
    "dim_perfil": "Names of the possible sets of elevated traits.",
    "fato_resposta_item": "One row per respondent and question, before and after reverse coding.",
    "fato_escore_respondente": "Trait scores of each respondent, which of them are elevated, and the profile.",
    "corte_traco": "Score of each trait that three quarters of the respondents do not exceed.",
    "respostas_brutas": "Raw answers exactly as read, all text, with load time and source file.",
    "respostas_tipadas": "All answers as numbers, text that is none as null; nobody left out.",
    "respostas": "Valid respondents, one row each, answers as numbers in their original direction.",
}


class Trait(NamedTuple):
    label: str
    slug: str
    item_ids: list[str]

    @property
    def score_column(self) -> str:
        return f"escore_{self.slug}"

    @property
    def flag_column(self) -> str:
        return f"elevado_{self.slug}"


TRAITS = [
    Trait(label, label.lower(), [i for i, trait, _, _ in QUESTIONS if trait == label])
    for label in ("Maquiavelismo", "Narcisismo", "Psicopatia")
]
ITEMS = [q[0] for q in QUESTIONS]
LIST = ", ".join(ITEMS)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _h(j: int) -> str:
    u = f"((k * 7919 + {j * 104729 + 12345}) % 1000003)"
    return f"(({u} * {u}) % 1000003)"


def _bump(j: int) -> str:
    return f"(CASE {_h(j)} % 8 WHEN 0 THEN -1 WHEN 7 THEN 1 ELSE 0 END)"


def _item(j: int) -> str:
    trait = j // 9
    bias = f"({_h(600 + j)} % 2)" if trait == 0 else "0"
    value = f"least(5, greatest(1, 3 + {bias} + {_bump(100)} + {_bump(101 + trait)} + ({_h(j)} % 3 - 1)))"
    if QUESTIONS[j][3]:
        value = f"(6 - {value})"
    return f"""CASE WHEN {_h(300)} % 500 = 0 THEN cast(k % 6 AS varchar)
        WHEN {_h(200)} % 40 = 0 AND {_h(201)} % 27 = {j} THEN '0'
        WHEN {_h(202)} % 400 = 0 AND {_h(203)} % 27 = {j} THEN NULL
        WHEN {_h(204)} % 800 = 0 AND {_h(205)} % 27 = {j} THEN 'x'
        WHEN {_h(206)} % 900 = 0 AND {_h(207)} % 27 = {j} THEN '7'
        ELSE cast({value} AS varchar) END AS {ITEMS[j]}"""


_PARTS: list[tuple[str, str, tuple[str, ...]]] = [
    (
        "survey",
        f"""SELECT k AS src_row, {", ".join(_item(j) for j in range(27))},
        CASE {_h(500)} % 200 WHEN 0 THEN '' WHEN 1 THEN NULL
          ELSE concat(' N', cast(least(c % 25, c % 7) AS varchar), ' ') END AS country,
        cast({_h(501)} % 4 + 1 AS varchar) AS source
        FROM (SELECT o_orderkey AS k, o_custkey AS c FROM orders)""",
        (),
    ),
    (
        "typed",
        f"""SELECT src_row, {", ".join(f"try_cast({c} AS integer) AS {c}" for c in ITEMS)},
        trim(country) AS country, try_cast(source AS integer) AS source FROM survey""",
        ("survey",),
    ),
    (
        "silver",
        f"""SELECT row_number() OVER (ORDER BY src_row) AS id_respondente, * FROM typed
        WHERE {" AND ".join(f"{c} <> 0" for c in ITEMS)} AND len(list_distinct([{LIST}])) > 1""",
        ("typed",),
    ),
    (
        "items",
        "SELECT * FROM (VALUES "
        + ", ".join(
            f"({_text(i)}, {_text(t)}, {_text(wording)}, {str(turned).lower()})"
            for i, t, wording, turned in QUESTIONS
        )
        + ") v(id_item, traco, texto_item, invertido)",
        (),
    ),
    (
        "profiles",
        "SELECT * FROM (VALUES "
        + ", ".join(
            f"({c}, {_text(label)}, {bin(c).count('1')})" for c, label in enumerate(PROFILES)
        )
        + ") v(id_perfil, descricao_perfil, qtd_tracos_elevados)",
        (),
    ),
    (
        "answers",
        f"""SELECT id_respondente, a.id_item, traco, invertido, v AS resposta_original,
        CASE WHEN invertido THEN 6 - v ELSE v END AS resposta_corrigida
        FROM (SELECT id_respondente, unnest([{", ".join(map(_text, ITEMS))}]) AS id_item,
                     unnest([{LIST}]) AS v FROM silver) a JOIN items USING (id_item)""",
        ("silver", "items"),
    ),
    (
        "scores",
        "SELECT id_respondente, "
        + ", ".join(
            f"round(avg(resposta_corrigida) FILTER (WHERE traco = '{t.label}'), 4) AS {t.score_column}"
            for t in TRAITS
        )
        + " FROM answers GROUP BY id_respondente",
        ("answers",),
    ),
    (
        "cuts",
        "SELECT "
        + ", ".join(f"quantile_disc({t.score_column}, 0.75) AS {t.slug}" for t in TRAITS)
        + " FROM scores",
        ("scores",),
    ),
    (
        "flags",
        "SELECT s.*, "
        + ", ".join(f"{t.score_column} > (SELECT {t.slug} FROM cuts) AS {t.flag_column}" for t in TRAITS)
        + " FROM scores s",
        ("scores", "cuts"),
    ),
    (
        "facts",
        """SELECT *, cast(elevado_maquiavelismo AS integer) * 4 + cast(elevado_narcisismo AS integer) * 2
        + cast(elevado_psicopatia AS integer) AS id_perfil FROM flags""",
        ("flags",),
    ),
    (
        "long_scores",
        " UNION ALL ".join(
            f"SELECT '{t.label}' AS traco, {t.score_column} AS valor, {t.flag_column} AS elevado FROM facts"
            for t in TRAITS
        ),
        ("facts",),
    ),
    (
        "provisional",
        "SELECT src_row, "
        + ", ".join(
            "round(list_sum([x FOR x IN [{0}] IF x > 0]) / len([x FOR x IN [{0}] IF x > 0]), 9) AS {1}".format(
                ", ".join(t.item_ids), t.slug
            )
            for t in TRAITS
        )
        + " FROM typed",
        ("typed",),
    ),
    (
        "long_provisional",
        " UNION ALL ".join(
            f"SELECT '{t.slug}' AS traco, {t.slug} AS valor FROM provisional WHERE {t.slug} IS NOT NULL"
            for t in TRAITS
        ),
        ("provisional",),
    ),
    (
        "respondents",
        """SELECT id_respondente, country AS pais_acesso, source AS id_origem,
        CASE source WHEN 1 THEN 'Página inicial do site' WHEN 2 THEN 'Busca no Google'
          WHEN 3 THEN 'Outra origem' ELSE 'Não identificada' END AS origem_acesso FROM silver""",
        ("silver",),
    ),
]
_NEEDS = {name: needs for name, _, needs in _PARTS}


def _with(needs: str, body: str) -> str:
    """Prefix the named parts, and what they build on, as common table expressions."""
    wanted: set[str] = set()
    todo = needs.split()
    while todo:
        part = todo.pop()
        if part not in wanted:
            wanted.add(part)
            todo += _NEEDS[part]
    parts = [f"{name} AS MATERIALIZED ({sql})" for name, sql, _ in _PARTS if name in wanted]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _pct(part: str, total: str, digits: int = 2) -> str:
    """Percent rounded half-up without floating point."""
    unit = 10**digits
    return f"((cast({200 * unit} * ({part}) + ({total}) AS bigint) // cast(2 * ({total}) AS bigint)) / {float(unit)})"


def _mean2(total: str, n: str) -> str:
    return f"((cast(200 * ({total}) + ({n}) AS bigint) // cast(2 * ({n}) AS bigint)) / 100.0)"


def _per_item(body: str) -> str:
    return " UNION ALL ".join(body.format(c=c) for c in ITEMS)


def _summary(needs: str, table: str) -> str:
    return _with(
        needs,
        f"""SELECT traco, count(*) AS n, round(avg(valor), 6) AS media,
        round(stddev_samp(valor), 6) AS desvio_padrao, min(valor) AS minimo,
        quantile_disc(valor, 0.25) AS q25, quantile_disc(valor, 0.5) AS q50,
        quantile_disc(valor, 0.75) AS q75, max(valor) AS maximo FROM {table} GROUP BY traco""",
    )


def _outliers(group: str, table: str, digits: int) -> str:
    return f"""SELECT {group}, q1, q3, limite_inf, limite_sup,
        count(*) FILTER (WHERE round(valor, {digits}) < limite_inf) AS n_low,
        count(*) FILTER (WHERE round(valor, {digits}) > limite_sup) AS n_high,
        count(*) FILTER (WHERE round(valor, {digits}) < limite_inf OR round(valor, {digits}) > limite_sup) AS n_total
        FROM {table} JOIN (
          SELECT *, round(q1 - 1.5 * (q3 - q1), {digits}) AS limite_inf,
                    round(q3 + 1.5 * (q3 - q1), {digits}) AS limite_sup
          FROM (SELECT {group}, quantile_disc(valor, 0.25) AS q1, quantile_disc(valor, 0.75) AS q3
                FROM {table} GROUP BY {group})) USING ({group})
        GROUP BY ALL"""


def _group_means(by: str, having: str = "", label: str = "") -> str:
    return _with(
        "facts respondents",
        f"""SELECT {by}, count(*) AS respondentes, round(avg(escore_maquiavelismo), 2) AS maquiavelismo,
        round(avg(escore_narcisismo), 2) AS narcisismo, round(avg(escore_psicopatia), 2) AS psicopatia{label}
        FROM facts JOIN respondents USING (id_respondente) GROUP BY {by} {having}""",
    )


def _elevated_count() -> str:
    return _with(
        "facts profiles",
        f"""SELECT qtd_tracos_elevados, count(*) AS qtd_respondentes,
        {_pct("count(*)", "(SELECT count(*) FROM facts)")} AS percentual
        FROM facts JOIN profiles USING (id_perfil) GROUP BY ALL""",
    )


def _item_chart(where: str = "") -> str:
    return _with(
        "answers items",
        f"""SELECT a.traco, a.id_item, texto_item, i.invertido,
        a.id_item || CASE WHEN i.invertido THEN '*' ELSE '' END AS rotulo,
        {_mean2("sum(resposta_corrigida)", "count(*)")} AS media
        FROM answers a JOIN items i USING (id_item) {where} GROUP BY ALL""",
    )


def _corr(a: str, b: str) -> str:
    return f"round(corr({a}, {b}), 4)"


def _each() -> dict[str, str]:
    nulls = "(" + " + ".join(f"cast({c} IS NULL AS integer)" for c in ITEMS) + ")"
    blanks = "(" + " + ".join(f"cast(coalesce({c} = 0, false) AS integer)" for c in ITEMS) + ")"
    distinct = f"len(list_distinct([{LIST}])) + (CASE WHEN {nulls} > 0 THEN 1 ELSE 0 END)"
    wild = "(" + " OR ".join(f"{c} > 5 OR {c} < 0" for c in ITEMS) + ")"
    M, N, P = (t.score_column for t in TRAITS)
    fM, fN, fP = (t.flag_column for t in TRAITS)
    scores = f"id_respondente, {M}, {N}, {P}"
    answers = "id_respondente, id_item, traco, resposta_original, resposta_corrigida"
    n_facts = "(SELECT count(*) FROM facts)"
    tables = {  # the part with as many rows, and the layer and columns of the table
        "respostas_brutas": ("survey", "bronze", 32),
        "respostas_tipadas": ("survey", "bronze", 31),
        "respostas": ("silver", "silver", 32),
        "dim_item": ("items", "gold", 4),
        "dim_respondente": ("respondents", "gold", 5),
        "dim_perfil": ("profiles", "gold", 3),
        "fato_resposta_item": ("answers", "gold", 5),
        "fato_escore_respondente": ("facts", "gold", 8),
        "corte_traco": ("(SELECT unnest([1, 2, 3]))", "gold", 2),
    }
    fact_types = [("id_respondente", "bigint")]
    fact_types += [(c, "double") for c in (M, N, P)]
    fact_types += [(c, "boolean") for c in (fM, fN, fP)] + [("id_perfil", "int")]
    score_note = "mean corrected answer, four decimals"
    fact_notes = {"id_respondente": "dense number, 1 to the row count"} | dict.fromkeys((M, N, P), score_note)
    fact_notes |= dict.fromkeys((fM, fN, fP), "score strictly above the cut")
    fact_notes["id_perfil"] = "elevated traits as bits, first trait highest"

    return {
        "lineage_columns": "SELECT 'orders.parquet' AS arquivo, count(*) AS registros, count(*) AS com_data FROM orders",
        "typed_survey": _with("typed", f"SELECT src_row, {LIST}, country, source FROM typed"),
        "typed_view": _with(
            "typed",
            """SELECT source, count(*) AS registros, count(country) AS com_pais, max(M1) AS maior_m1
            FROM typed GROUP BY source""",
        ),
        "missing_profile": _with(
            "typed",
            _per_item(
                "SELECT '{c}' AS campo, count(*) FILTER (WHERE {c} IS NULL) AS nulos, "
                "count(*) FILTER (WHERE {c} = 0) AS zeros, "
                + _pct("count(*) FILTER (WHERE {c} IS NULL OR {c} = 0)", "count(*)")
                + " AS pct_ausente FROM typed"
            ),
        ),
        "blank_count_histogram": _with(
            "typed",
            f"""SELECT cast(CASE WHEN {nulls} > 0 THEN NULL ELSE {blanks} END AS integer) AS qtd_zeros,
            count(*) AS count FROM typed GROUP BY 1""",
        ),
        "context_missing": _with(
            "survey",
            """SELECT count(*) FILTER (WHERE country IS NULL OR trim(country) = '') AS country_ausente,
            count(*) FILTER (WHERE source IS NULL) AS source_ausente FROM survey""",
        ),
        "domain_violations": _with("typed", f"SELECT src_row, {LIST} FROM typed WHERE {wild}"),
        "domain_violation_count": _with(
            "typed", f"SELECT count(*) AS fora_do_dominio FROM typed WHERE {wild}"
        ),
        "domain_profile": _with(
            "typed",
            _per_item(
                "SELECT '{c}' AS campo, min({c}) AS minimo, max({c}) AS maximo, "
                + _mean2("sum({c}) FILTER (WHERE {c} > 0)", "count(*) FILTER (WHERE {c} > 0)")
                + " AS media_validos FROM typed"
            ),
        ),
        "duplicate_summary": _with(
            "typed",
            f"""SELECT (SELECT count(*) FROM typed) AS total, count(*) AS distintas,
            (SELECT count(*) FROM typed) - count(*) AS repetidas FROM (SELECT DISTINCT {LIST} FROM typed)""",
        ),
        "duplicate_groups": _with(
            "typed",
            f"""SELECT {LIST}, count(*) AS count FROM typed GROUP BY {LIST} HAVING count(*) > 1
            ORDER BY count DESC, {", ".join(f"{c} ASC NULLS FIRST" for c in ITEMS)} LIMIT 10""",
        ),
        "straight_line_histogram": _with(
            "typed",
            f"SELECT M1 AS valor_repetido, count(*) AS count FROM typed WHERE {distinct} = 1 GROUP BY M1",
        ),
        "distinct_value_histogram": _with(
            "typed",
            f"SELECT cast({distinct} AS integer) AS valores_distintos, count(*) AS count FROM typed GROUP BY 1",
        ),
        "provisional_scores": _with("provisional", "SELECT * FROM provisional"),
        "score_summary": _summary("long_provisional", "long_provisional"),
        "iqr_outliers": _with("long_provisional", _outliers("traco", "long_provisional", 9)),
        "country_top": _with(
            "survey",
            """SELECT country, count(*) AS count FROM survey GROUP BY country
            ORDER BY count DESC, country ASC NULLS FIRST LIMIT 20""",
        ),
        "source_frequency": _with("survey", "SELECT source, count(*) AS count FROM survey GROUP BY source"),
        "exclusion_funnel": _with(
            "typed silver",
            f"""SELECT count(*) AS total_inicial,
            count(*) FILTER (WHERE {nulls} > 0) AS com_item_nulo,
            count(*) FILTER (WHERE {nulls} = 0 AND {blanks} > 0) AS com_item_zero,
            count(*) FILTER (WHERE {nulls} > 0 OR {blanks} > 0) AS removidos_branco,
            count(*) FILTER (WHERE {nulls} = 0 AND {blanks} = 0) AS restantes,
            count(*) FILTER (WHERE {nulls} = 0 AND {blanks} = 0) - (SELECT count(*) FROM silver) AS removidos_uniforme,
            (SELECT count(*) FROM silver) AS registros_validos FROM typed""",
        ),
        "retention": _with(
            "silver survey",
            f"""SELECT (SELECT count(*) FROM survey) AS bronze, count(*) AS silver,
            {_pct("count(*)", "(SELECT count(*) FROM survey)")} AS retencao FROM silver""",
        ),
        "silver_range": _with(
            "silver",
            f"""SELECT min(list_min([{LIST}])) AS menor_valor, max(list_max([{LIST}])) AS maior_valor FROM silver""",
        ),
        "surrogate_id": _with("silver", "SELECT src_row, id_respondente FROM silver"),
        "silver_table": _with("silver", f"SELECT id_respondente, {LIST}, country, source FROM silver"),
        "preview": _with(
            "silver", f"SELECT id_respondente, {LIST} FROM silver ORDER BY id_respondente LIMIT 10"
        ),
        "dim_item": _with(
            "items answers",
            """SELECT id_item, i.traco, texto_item, i.invertido, count(*) AS respostas,
            min(resposta_original) AS minimo, max(resposta_original) AS maximo
            FROM items i JOIN answers a USING (id_item) GROUP BY ALL""",
        ),
        "dim_profile": _with(
            "profiles facts",
            """SELECT p.id_perfil, descricao_perfil, qtd_tracos_elevados, count(f.id_perfil) AS qtd_respondentes
            FROM profiles p LEFT JOIN facts f ON p.id_perfil = f.id_perfil GROUP BY ALL""",
        ),
        "dim_respondent": _with("respondents", "SELECT * FROM respondents"),
        "responses_long": _with("answers", f"SELECT {answers} FROM answers"),
        "responses_by_dimension": _with("answers", f"SELECT {answers} FROM answers"),
        "reverse_audit": _with(
            "answers",
            """SELECT id_item, count(*) AS respostas_alteradas FROM answers
            WHERE resposta_original <> resposta_corrigida GROUP BY id_item""",
        ),
        "trait_scores": _with("scores", f"SELECT {scores} FROM scores"),
        "trait_scores_pivot": _with("scores", f"SELECT {scores} FROM scores"),
        "gold_score_summary": _summary("long_scores", "long_scores"),
        "cutoffs": _with(
            "cuts",
            " UNION ALL ".join(f"SELECT '{t.label}' AS traco, {t.slug} AS corte FROM cuts" for t in TRAITS),
        ),
        "score_profiles": _with("facts", f"SELECT {scores}, {fM}, {fN}, {fP}, id_perfil FROM facts"),
        "trait_descriptives": _with(
            "long_scores",
            """SELECT traco, round(avg(valor), 2) AS media, round(stddev_samp(valor), 2) AS desvio_padrao,
            round(quantile_cont(valor, 0.5), 2) AS mediana, round(min(valor), 2) AS minimo,
            round(max(valor), 2) AS maximo FROM long_scores GROUP BY traco""",
        ),
        "score_bands": _with(
            "long_scores",
            f"""SELECT traco, floor(valor * 2) / 2 AS faixa, count(*) AS qtd,
            {_pct("count(*)", n_facts)} AS percentual FROM long_scores GROUP BY ALL""",
        ),
        "lattice_histogram": _with(
            "long_scores",
            """SELECT traco, bin, round(bin / 9.0 + 1, 4) AS centro, sum(n)::bigint AS qtd, media, corte FROM (
              SELECT traco, cast(round((valor - 1) * 9) AS integer) AS bin, 1 AS n FROM long_scores
              UNION ALL SELECT traco, cast(b AS integer), 0 FROM (SELECT DISTINCT traco FROM long_scores), range(37) r(b))
            JOIN (SELECT traco, round(avg(valor), 4) AS media, quantile_disc(valor, 0.75) AS corte
                  FROM long_scores GROUP BY traco) USING (traco) GROUP BY ALL""",
        ),
        "prevalence": _with(
            "long_scores",
            f"""SELECT traco, count(*) FILTER (WHERE elevado) AS qtd_elevados,
            {_pct("count(*) FILTER (WHERE elevado)", "count(*)")} AS pct_elevados
            FROM long_scores GROUP BY traco""",
        ),
        "co_occurrence": _with(
            "facts",
            " UNION ALL ".join(
                f"SELECT 'Elevado em {a.slug} → também em {b.slug}' AS relacao, "
                + _pct(f"count(*) FILTER (WHERE {b.flag_column})", "count(*)")
                + f" AS pct FROM facts WHERE {a.flag_column}"
                for i, a in enumerate(TRAITS)
                for b in TRAITS[i + 1 :]
            ),
        ),
        "trait_correlation": _with(
            "scores",
            " UNION ALL ".join(
                f"SELECT '{a.label} × {b.label}' AS par_de_tracos, "
                f"{_corr(a.score_column, b.score_column)} AS correlacao FROM scores"
                for i, a in enumerate(TRAITS)
                for b in TRAITS[i + 1 :]
            ),
        ),
        "correlation_matrix": _with(
            "scores",
            " UNION ALL ".join(
                f"SELECT '{a.label}' AS traco, "
                + ", ".join(f"{_corr(a.score_column, b.score_column)} AS {b.label}" for b in TRAITS)
                + " FROM scores"
                for a in TRAITS
            ),
        ),
        "profile_distribution": _with(
            "facts profiles",
            f"""SELECT descricao_perfil, qtd_tracos_elevados, count(*) AS qtd_respondentes,
            {_pct("count(*)", n_facts)} AS percentual
            FROM facts JOIN profiles USING (id_perfil) GROUP BY ALL""",
        ),
        "profile_chart": _with(
            "facts profiles",
            f"""SELECT descricao_perfil, qtd_tracos_elevados, count(*) AS count,
            {_pct("count(*)", n_facts, 1)} AS percentual
            FROM facts JOIN profiles USING (id_perfil) GROUP BY ALL""",
        ),
        "elevated_count_distribution": _elevated_count(),
        "elevated_count_sql": _elevated_count(),
        "item_endorsement": _with(
            "answers items",
            f"""SELECT a.traco, a.id_item, texto_item, i.invertido,
            {_mean2("sum(resposta_corrigida)", "count(*)")} AS media_corrigida,
            {_pct("count(*) FILTER (WHERE resposta_corrigida >= 4)", "count(*)")} AS pct_concordancia
            FROM answers a JOIN items i USING (id_item) GROUP BY ALL""",
        ),
        "item_chart": _item_chart(),
        "item_chart_panel": _item_chart("WHERE a.traco = 'Narcisismo'"),
        "group_means_country": _group_means("pais_acesso", "HAVING count(*) >= 200"),
        "group_means_origin": _group_means(
            "origem_acesso", label=", origem_acesso || ' (n=' || count(*) || ')' AS rotulo"
        ),
        "tsv_roundtrip": _with(
            "survey", f"SELECT cast(src_row AS varchar) AS src_row, {LIST}, nullif(country, '') AS country, source FROM survey"
        ),
        "table_versions": _with(
            "silver",
            f"""SELECT situacao, count(*) AS registros FROM (
              SELECT CASE WHEN {wild} THEN 'removido' WHEN {" AND ".join(f"{c} = 3" for c, _, _, turned in QUESTIONS if turned)} THEN 'igual'
                     ELSE 'alterado' END AS situacao FROM silver
              UNION ALL SELECT 'versao anterior' FROM silver
              UNION ALL SELECT 'versao atual' FROM silver WHERE NOT {wild}) GROUP BY situacao""",
        ),
        "incremental_landing": _with(
            "survey", f"SELECT cast(src_row AS varchar) AS src_row, {LIST}, nullif(country, '') AS country, source FROM survey"
        ),
        "stable_ids": _with(
            "silver",
            """SELECT src_row, primeira AS id_primeira_carga,
              coalesce(primeira, n + row_number() OVER (PARTITION BY primeira IS NULL ORDER BY src_row)) AS id_respondente
            FROM (SELECT src_row, CASE WHEN cedo THEN row_number() OVER (PARTITION BY cedo ORDER BY src_row) END AS primeira,
                         count(*) FILTER (WHERE cedo) OVER () AS n
                  FROM (SELECT src_row, coalesce(source IN (1, 2), false) AS cedo FROM silver))""",
        ),
        "sketched_price_cuts": """SELECT l_returnflag, count(*) AS n, count(DISTINCT l_linestatus) AS cargas, true AS dentro_do_erro
            FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag""",
        "refreshed_descriptives": _with(
            "long_scores",
            """SELECT traco, count(*) AS n, round(avg(valor), 6) AS media, round(stddev_samp(valor), 6) AS desvio_padrao,
            min(valor) AS minimo, max(valor) AS maximo FROM long_scores GROUP BY traco""",
        ),
        "refreshed_correlation": _with(
            "scores",
            " UNION ALL ".join(
                f"SELECT '{x.label}' AS a, '{y.label}' AS b, count(*) AS n, round(corr({x.score_column}, {y.score_column}), 6) AS correlacao FROM scores"
                for i, x in enumerate(TRAITS) for y in TRAITS[i + 1 :]
            ),
        ),
        "ragged_lines": _with(
            "survey",
            """SELECT CASE WHEN source = '4' THEN 'campos a menos' WHEN country = '' THEN 'campos a mais' ELSE 'linha inteira' END AS motivo,
            count(*) AS linhas FROM survey GROUP BY ALL""",
        ),
        "schema_versions": _with(
            "survey",
            f"""SELECT cast(src_row AS varchar) AS src_row, {LIST}, nullif(country, '') AS country,
            CASE WHEN NOT coalesce(source IN ('1', '2'), false) THEN source END AS source,
            CASE WHEN coalesce(source IN ('1', '2'), false) THEN 1 ELSE 2 END AS versao_esquema FROM survey""",
        ),
        "low_variability": _with(
            "typed",
            f"""SELECT src_row, len(v)::INTEGER AS validas, d AS desvio_linha, coalesce(m, 0)::INTEGER AS maior_sequencia,
              CASE WHEN d < 0.5 AND m >= 9 THEN 'desvio e sequencia' WHEN d < 0.5 THEN 'desvio' ELSE 'sequencia' END AS motivo
            FROM (SELECT src_row, v, round(list_aggregate(v, 'stddev_samp'), 6) AS d, list_aggregate(v, 'stddev_samp') AS exact
                  FROM (SELECT src_row, [x FOR x IN [{LIST}] IF x > 0] AS v FROM typed))
            LEFT JOIN (SELECT src_row, max(n) AS m FROM (
                SELECT src_row, count(*) AS n FROM (
                  SELECT src_row, x, p - row_number() OVER (PARTITION BY src_row, x ORDER BY p) AS island
                  FROM (SELECT src_row, unnest([{LIST}]) AS x, unnest(range(27)) AS p FROM typed) WHERE x > 0)
                GROUP BY src_row, x, island) GROUP BY src_row) USING (src_row)
            WHERE coalesce(exact < 0.5, false) OR m >= 9""",
        ),
        "text_head": _with(
            "typed",
            "SELECT concat_ws(chr(9), campo, lo, hi, mean) AS linha FROM ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS campo, min({c}) AS lo, max({c}) AS hi, "
                + _mean2(f"sum({c}) FILTER (WHERE {c} > 0)", f"count(*) FILTER (WHERE {c} > 0)")
                + " AS mean FROM typed"
                for c in ("M1", "M2", "M3")
            )
            + ")",
        ),
        "whole_text": _with(
            "typed",
            "SELECT string_agg(concat_ws(chr(9), campo, lo, hi, mean), chr(10) ORDER BY campo) || chr(10) AS texto FROM ("
            + _per_item(
                "SELECT '{c}' AS campo, min({c}) AS lo, max({c}) AS hi, "
                + _mean2("sum({c}) FILTER (WHERE {c} > 0)", "count(*) FILTER (WHERE {c} > 0)")
                + " AS mean FROM typed"
            )
            + ")",
        ),
        "catalog_listing": _with(
            " ".join(part for part, _, _ in tables.values() if part in _NEEDS),
            " UNION ALL ".join(
                f"SELECT '{layer}' AS camada, '{name}' AS tabela, count(*) AS registros, {width} AS colunas, "
                f"{_text(TABLE_NOTES[name])} AS comentario FROM {part}"
                for name, (part, layer, width) in tables.items()
            ),
        ),
        "table_description": _with(
            "facts",
            " UNION ALL ".join(
                f"SELECT '{c}' AS campo, '{kind}' AS tipo, {_text(fact_notes[c])} AS descricao, "
                f"count({c}) AS preenchidos, cast(min({c}) AS varchar) AS minimo, "
                f"cast(max({c}) AS varchar) AS maximo FROM facts"
                for c, kind in fact_types
            ),
        ),
        "iqr_outliers_price": "WITH prices AS (SELECT l_returnflag, l_extendedprice AS valor FROM lineitem "
        "WHERE l_extendedprice IS NOT NULL) " + _outliers("l_returnflag", "prices", 6),
        "price_summary": """SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS media,
        round(stddev_samp(l_extendedprice), 4) AS desvio_padrao, min(l_extendedprice) AS minimo,
        quantile_disc(l_extendedprice, 0.25) AS q25, quantile_disc(l_extendedprice, 0.5) AS q50,
        quantile_disc(l_extendedprice, 0.75) AS q75, max(l_extendedprice) AS maximo,
        round(median(l_extendedprice), 4) AS mediana
        FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag""",
        "correlation_lineitem": " UNION ALL ".join(
            f"SELECT '{a} × {b}' AS par, {_corr(a, b)} AS correlacao FROM lineitem"
            for a, b in (
                ("l_quantity", "l_extendedprice"),
                ("l_quantity", "l_discount"),
                ("l_discount", "l_tax"),
            )
        ),
        "missing_events": " UNION ALL ".join(
            f"SELECT '{c}' AS campo, count(*) FILTER (WHERE {c} IS NULL) AS nulos, count(*) AS total FROM events"
            for c in ("event_id", "ts", "user_id", "event_type", "value", "props")
        ),
    }


#: Questions that two queries answer by different ways.
_SAME = {"growing_profiles": "profile_distribution", "observed_funnel": "exclusion_funnel", "score_bands_sql": "score_bands", "item_endorsement_sql": "item_endorsement"}


def all_oracles() -> dict[str, str]:
    each = _each()
    return each | {name: each[other] for name, other in _SAME.items()}
