import json

import pytest

from fiscalake.schemas import RAW, RAW_COLUMNS
from fiscalake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


def record(code, **changes):
    """One raw record as it comes from the source: everything but the year is text."""
    base = {
        "codigoEmenda": code,
        "ano": 2023,
        "tipoEmenda": "Emenda Individual - Finalidade Definida",
        "autor": "ana lima",
        "nomeAutor": "ana lima",
        "numeroEmenda": "0001",
        "localidadeDoGasto": "CEARÁ (UF)",
        "funcao": "saúde",
        "subfuncao": "atenção básica",
        "valorEmpenhado": "1.000,00",
        "valorLiquidado": "500,00",
        "valorPago": "500,00",
        "valorRestoInscrito": "0,00",
        "valorRestoCancelado": "0,00",
        "valorRestoPago": "0,00",
    }
    return base | changes


@pytest.fixture(scope="session")
def raw_frame(spark):
    def make(records):
        return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in records], RAW)

    return make


@pytest.fixture(scope="session")
def many_records():
    """A few hundred invented records with repeated codes, ties, blanks and a hot author."""
    authors = ["ana lima", "BRUNO SÁ", "com. saúde", "dora d'ávila", "eva", "fred"]
    kinds = ["Emenda Individual", "Emenda de Comissão", "EMENDA DE BANCADA", "relator"]
    places = ["CEARÁ (UF)", "SÃO PAULO (UF)", "Nacional", "AMAZONAS (UF)", "FORTALEZA - CE", None, "GOIÁS (UF)"]
    functions = ["saúde", "educação", "defesa nacional", "transporte", "direitos da cidadania"]
    out = []
    for i in range(300):
        committed = (i * 7919) % 5000
        paid = committed * ((i * 31) % 110) // 100
        out.append(
            record(
                f"C{i % 270:04d}",
                ano=2020 + i % 6,
                autor=authors[0 if i % 3 == 0 else i % 6],
                tipoEmenda=kinds[(i // 2) % 4],
                localidadeDoGasto=places[i % 7],
                funcao=functions[(i * i) % 5],
                subfuncao=None if i % 11 == 0 else f"sub {i % 4}",
                numeroEmenda=f"{i:04d}",
                valorEmpenhado=f"{committed:,}".replace(",", ".") + ",50",
                valorPago=None if i % 17 == 0 else f"{paid:,}".replace(",", ".") + ",25",
                valorRestoInscrito=f"{i % 5 * 100},00",
                valorRestoCancelado=f"{i % 3 * 10},00",
            )
        )
    return out


@pytest.fixture
def write_json(tmp_path):
    def write(name, value):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(value, ensure_ascii=False, indent=1), encoding="utf-8")
        return str(path)

    return write
