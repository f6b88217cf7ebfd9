"""Schemas and column vocabulary of every layer."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


# The published column names of the layers, and the element names of the NF-e layout that they are read from.

# ---- parsed invoice document ------------------------------------------------
ITEM_FIELDS = [
    "numero_item", "codigo", "descricao", "ncm", "cfop",
    "unidade", "quantidade", "valor_unitario", "valor_total_item",
]
HEADER_FIELDS = [
    "id_nfe", "numero_nfe", "serie", "data_emissao", "natureza_operacao",
    "cnpj_emitente", "nome_emitente", "uf_emitente", "municipio_emitente",
    "cpf_destinatario", "cnpj_destinatario", "nome_destinatario",
    "valor_produtos", "valor_desconto", "valor_total_nf",
]
# the flat 16-column invoice frame: header + provenance, all text
INVOICE_FIELDS = HEADER_FIELDS + ["arquivo_origem"]
INVOICE = StructType(_strings(*INVOICE_FIELDS))
ITEM = StructType(_strings(*ITEM_FIELDS))
INVOICE_WITH_ITEMS = StructType(
    _strings(*HEADER_FIELDS) + [StructField("itens", ArrayType(ITEM), True)] + _strings("arquivo_origem")
)

# Invoice XML (NF-e layout) as the lot writer has it: attributes prefixed "_".
_PROD = StructType(_strings("cProd", "xProd", "NCM", "CFOP", "uCom", "qCom", "vUnCom", "vProd"))
INF_NFE = StructType(
    [
        StructField("_Id", StringType(), True),
        StructField("ide", StructType(_strings("natOp", "serie", "nNF", "dhEmi")), True),
        StructField(
            "emit",
            StructType(
                _strings("CNPJ", "xNome") + [StructField("enderEmit", StructType(_strings("xMun", "UF")), True)]
            ),
            True,
        ),
        StructField("dest", StructType(_strings("CPF", "CNPJ", "xNome")), True),
        StructField(
            "det",
            ArrayType(StructType([StructField("_nItem", StringType(), True), StructField("prod", _PROD, True)])),
            True,
        ),
        StructField("total", StructType([StructField("ICMSTot", StructType(_strings("vProd", "vDesc", "vNF")), True)]), True),
    ]
)
# ---- messages and raw layer ---------------------------------------------------
KAFKA_RECORD = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
        StructField("timestampType", IntegerType(), True),
    ]
)
BRONZE = StructType(
    [
        StructField("payload", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
    ]
)
BRONZE_ORDER = ["timestamp", "partition", "offset"]  # latest message wins

# ---- clean layer ----------------------------------------------------------------
SILVER_TEXT_FIELDS = [
    "id_nfe", "numero_nfe", "serie", "data_emissao", "natureza_operacao",
    "cnpj_emitente", "nome_emitente", "uf_emitente", "municipio_emitente", "nome_destinatario",
]
AMOUNT_FIELDS = ["valor_produtos", "valor_desconto", "valor_total_nf"]
SILVER_FIELDS = SILVER_TEXT_FIELDS + AMOUNT_FIELDS + ["arquivo_origem"]
REQUIRED_FIELDS = ["id_nfe", "cnpj_emitente", "valor_total_nf", "data_emissao"]
POSITIVE_FIELDS = ["valor_total_nf", "valor_produtos"]
NON_NEGATIVE_FIELDS = ["valor_desconto"]
TRIMMED_FIELDS = ["nome_emitente", "municipio_emitente", "natureza_operacao", "nome_destinatario"]

# ---- star schema ------------------------------------------------------------------
DIM_EMITENTE = ["id_emitente", "cnpj", "nome", "uf", "municipio"]
DIM_DATA = ["id_data", "data", "dia", "mes", "ano", "trimestre"]
DIM_LOCALIDADE = ["id_localidade", "uf", "regiao", "estado_completo"]
FATO_VENDAS = [
    "id_venda", "id_nfe", "id_emitente", "id_data", "id_localidade",
    "valor_total", "valor_produtos", "valor_desconto",
]
