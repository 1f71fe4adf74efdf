"""The row-local building blocks as SQL functions, for questions asked in SQL.

They are made from the instrument and have SQL bodies, which Spark writes into the query before it
optimises it: no Python runs, and filters and column choices pass through.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from likertlake.instrument import Instrument


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def definitions(spec: Instrument) -> dict[str, str]:
    """Signature, type and body of each function, by name."""
    turned = ", ".join(_text(i) for i in spec.item_ids if i in spec.reversed_ids)
    bits = " + ".join(f"CAST({t.flag_column} AS INT) * {1 << (len(spec.traits) - 1 - k)}" for k, t in enumerate(spec.traits))
    flags = ", ".join(f"{t.flag_column} BOOLEAN" for t in spec.traits)
    routes = " ".join(f"WHEN {code} THEN {_text(label)}" for code, label in spec.origin_labels.items())
    default = _text(spec.origin_default)
    names = " ".join(f"WHEN {code} THEN {_text(label)}" for code, label in enumerate(spec.profile_labels))
    return {
        "item_invertido": f"(id_item STRING) RETURNS BOOLEAN RETURN coalesce(id_item IN ({turned or 'NULL'}), false)",
        "resposta_corrigida": f"(id_item STRING, resposta INT) RETURNS INT RETURN CASE WHEN id_item IN ({turned or 'NULL'}) THEN {spec.lo + spec.hi} - resposta ELSE resposta END",
        "rotulo_item": f"(id_item STRING) RETURNS STRING RETURN concat(id_item, CASE WHEN id_item IN ({turned or 'NULL'}) THEN '*' ELSE '' END)",
        "faixa_escore": "(escore DOUBLE, por_unidade INT) RETURNS DOUBLE RETURN floor(escore * por_unidade) / por_unidade",
        "codigo_perfil": f"({flags}) RETURNS INT RETURN {bits}",
        "rotulo_perfil": f"(codigo INT) RETURNS STRING RETURN CASE codigo {names} END",
        "rotulo_origem": f"(codigo INT) RETURNS STRING RETURN {f'CASE codigo {routes} ELSE {default} END' if routes else default}",
        "media_validos": f"(respostas ARRAY<INT>) RETURNS DOUBLE RETURN try_divide(aggregate(filter(respostas, x -> x > {spec.missing}), 0L, (total, x) -> total + x), size(filter(respostas, x -> x > {spec.missing})))",
    }


def register(spark: SparkSession, spec: Instrument) -> list[str]:
    """Make the functions known to the session under their names, in place of earlier ones; the names.

    A null answer stays null, as does the code of a profile with a null flag; ``media_validos`` is null if no answer is above the
    missing code; an unknown route has the default label, an unknown profile none.
    """
    for name, body in definitions(spec).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(definitions(spec))
