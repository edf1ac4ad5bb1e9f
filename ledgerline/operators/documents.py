"""Document shaping (P1-P4, F8, F9, K3): projection, renaming, schema enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import camel_name, epoch_millis, iso_millis
from ledgerline.schemas import DOC_KEY, ENR, ENR_COLS

# snake_case source column -> camelCase document field
DOC_FIELDS = {
    "codigo_lancamento": "codigoLancamento",
    "numero_unico_conta": "numeroUnicoConta",
    "valor_total_transacao": "valorTotalTransacao",
    "data_completa_transacao": "dataCompletaTransacao",
    "tipo_transacao": "tipoTransacao",
    "tipo_produto_transacao": "tipoProdutoTransacao",
    "nome_titular_conta": "nomeTitularConta",
    "data_nascimento_titular_conta": "dataNascimentoTitularConta",
    "zip_code": "zipCode",
}


def to_document(joined: DataFrame, keep=()) -> DataFrame:
    """The nine camelCase fields; registration date dropped; ``keep`` passes through."""
    return joined.select(*[F.col(src).alias(dst) for src, dst in DOC_FIELDS.items()], *keep)


def camelize(df: DataFrame) -> DataFrame:
    """Rename every snake/kebab column to camelCase (driver-side names only)."""
    return df.toDF(*[camel_name(c) for c in df.columns])


class SchemaMismatch(ValueError):
    pass


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the contract, drop extra columns, fail on a missing column."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def check_schema(df: DataFrame, expected: T.StructType = ENR) -> list[tuple[str, str, str, bool]]:
    """Q3 helper: (field, expected type, actual type or '', ok) per expected and extra field."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(f.name, f.dataType.simpleString(), actual.get(f.name, ""),
             actual.get(f.name) == f.dataType.simpleString()) for f in expected.fields]
    rows += [(n, "", t, False) for n, t in actual.items() if n not in {f.name for f in expected.fields}]
    return rows


def doc_struct(df: DataFrame, date_format: str = "epoch_millis", cols=ENR_COLS):
    """Document struct with timestamps as epoch millis (as coded) or ISO text."""
    fields = []
    for f in df.select(*cols).schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = epoch_millis(c) if date_format == "epoch_millis" else iso_millis(c)
        fields.append(c.alias(f.name))
    return F.struct(*fields)


def doc_json(df: DataFrame, date_format: str = "epoch_millis", cols=ENR_COLS):
    """F8: document JSON, absent customer as explicit ``null``."""
    return F.to_json(doc_struct(df, date_format, cols), {"ignoreNullFields": "false"})


def action_json(index: str, key: str = DOC_KEY):
    """``{"index":{"_index":...,"_id":...}}`` with the id escaped by to_json."""
    return F.to_json(F.struct(F.struct(F.lit(index).alias("_index"),
                                       F.col(key).alias("_id")).alias("index")))


def to_bulk_ndjson(docs: DataFrame, index: str, key: str = DOC_KEY,
                   date_format: str = "epoch_millis") -> DataFrame:
    """K3: two lines per document, action then source, adjacent and in order.

    ``explode`` keeps the pair inside one task, so a text write of ``line``
    preserves adjacency without a sort.
    """
    pair = F.array(F.struct(F.lit(0).alias("line_no"), action_json(index, key).alias("line")),
                   F.struct(F.lit(1).alias("line_no"), doc_json(docs, date_format).alias("line")))
    return docs.select(F.col(key), F.explode(pair).alias("p")).select(key, "p.line_no", "p.line")


def write_bulk_ndjson(docs: DataFrame, path: str, index: str, key: str = DOC_KEY,
                      date_format: str = "epoch_millis") -> str:
    """K3 sink: bulk request bodies as text files, one action+document pair per document.

    Each task writes its own body file; pairs stay adjacent because ``explode``
    emits them consecutively and nothing re-orders rows before the text writer.
    """
    to_bulk_ndjson(docs, index, key, date_format).select("line").write.text(path)
    return path
