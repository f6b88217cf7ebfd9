"""Small builders for hostile fixture rows."""

import datetime as dt
import json

from ledgerlake import schemas as S

BASE = {
    "id_nfe": "NFe1",
    "numero_nfe": "1",
    "serie": "1",
    "data_emissao": "2021-01-29T10:32:11-03:00",
    "natureza_operacao": "VENDA DE MERCADORIA",
    "cnpj_emitente": "00000000000191",
    "nome_emitente": "EMITENTE A",
    "uf_emitente": "SP",
    "municipio_emitente": "SAO PAULO",
    "cpf_destinatario": "12345678909",
    "cnpj_destinatario": None,
    "nome_destinatario": "DESTINATARIO",
    "valor_produtos": "100.00",
    "valor_desconto": "0.00",
    "valor_total_nf": "100.00",
    "arquivo_origem": "nfe_001.xml",
}


def invoice(**over):
    r = dict(BASE)
    r.update(over)
    return r


def bronze_df(spark, payloads):
    """payloads: list of dict (serialised) or str (raw); offsets follow the list order."""
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i, p in enumerate(payloads):
        text = p if (p is None or isinstance(p, str)) else json.dumps(p, ensure_ascii=False)
        rows.append((text, 0, i, t0 + dt.timedelta(minutes=i)))
    return spark.createDataFrame(rows, S.BRONZE)


def silver_df(spark, invoices):
    """Already-clean rows (amounts as double)."""
    rows = []
    for r in invoices:
        rows.append(tuple(
            (float(r[c]) if r[c] is not None else None) if c in S.AMOUNT_FIELDS else r[c] for c in S.SILVER_FIELDS
        ))
    schema = ", ".join(f"{c} {'double' if c in S.AMOUNT_FIELDS else 'string'}" for c in S.SILVER_FIELDS)
    return spark.createDataFrame(rows, schema)


def records_df(spark, invoices):
    """The 16-column text invoice frame."""
    return spark.createDataFrame([tuple(r.get(c) for c in S.INVOICE_FIELDS) for r in invoices], S.INVOICE)
