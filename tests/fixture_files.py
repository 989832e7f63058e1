"""Small hand-made extract files for the end-to-end test."""

from __future__ import annotations

import random
from pathlib import Path

from cartulary.sources.layouts import CONTRACTS, DEFICIT, FAMILY, MUNICIPALITIES, PERSON

REGIONS = ("North", "Northeast", "Southeast", "South", "Center-West")


def with_digits(nine: int) -> str:
    digits = [int(c) for c in f"{nine:09d}"]
    for n in (9, 10):
        r = sum(d * (n + 1 - i) for i, d in enumerate(digits[:n])) % 11
        digits.append(0 if r < 2 else 11 - r)
    return "".join(map(str, digits))


def municipality(n: int) -> int:
    base = f"{110000 + n * 37}"
    total = sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(base))
    return int(base + str(-total % 10))


def lines(layout, rows, header=None) -> str:
    body = [";".join(str(row.get(name, "")) for name in layout.names) for row in rows]
    return "\n".join([header or ";".join(layout.names), *body]) + "\n"


def family(rng: random.Random, n: int, areas: list[int], updated: str) -> dict:
    rent = rng.choice(["", "", "350,00", "1.200,00"])
    return {
        "CD_IBGE_CADASTRO": rng.choice(areas), "CO_FAMILIAR_FAM": f"{n:011d}", "DT_CADASTRO_FAM": "01022020",
        "DT_ATUALIZACAO_FAM": updated, "CO_EST_CADASTRAL_FAM": 3 if n % 10 else 1, "NO_LOGRADOURO_FAM": "Rua São João",
        "NU_CEP_LOGRADOURO_FAM": f"{70000000 + n}", "CO_ESPECIE_DOMIC_FAM": rng.choice([1, 1, 1, 2]),
        "QT_COMODOS_DOMIC_FAM": 5, "QT_COMODOS_DORMITORIO_FAM": rng.randint(1, 3),
        "CO_MATERIAL_PISO_FAM": rng.randint(1, 4), "CO_MATERIAL_DOMIC_FAM": rng.randint(1, 6),
        "CO_AGUA_CANALIZADA_FAM": rng.randint(1, 2), "CO_BANHEIRO_DOMIC_FAM": rng.randint(1, 2),
        "CO_ESCOA_SANITARIO_DOMIC_FAM": rng.randint(1, 6), "CO_DESTINO_LIXO_DOMIC_FAM": rng.randint(1, 6),
        "CO_ILUMINACAO_DOMIC_FAM": rng.randint(1, 6), "QT_PESSOAS_DOMIC_FAM": rng.randint(1, 8),
        "QT_FAMILIAS_DOMIC_FAM": rng.choice([1, 1, 1, 2]), "VL_DESP_ALUGUEL_FAM": rent,
        "VL_RENDA_TOTAL_FAM": f"{rng.randint(300, 6000)},50", "QT_MEMBRO_FAMILIA": rng.randint(0, 5),
    }


def person(rng: random.Random, n: int, areas: list[int]) -> dict:
    return {
        "CD_IBGE_CADASTRO": rng.choice(areas), "CO_FAMILIAR_FAM": f"{n:011d}", "CO_CHV_NATURAL_PESSOA": f"{n + 5000}",
        "DT_CADASTRAMENTO_MEMB": "2020-02-01", "NO_PESSOA": f"PESSOA NÚMERO {n}", "CO_SEXO_PESSOA": rng.randint(1, 2),
        "DT_NASC_PESSOA": f"{rng.randint(1, 28):02d}/{rng.randint(1, 12):02d}/{rng.randint(1940, 2020)}",
        "NU_CPF_PESSOA": with_digits(100000000 + n), "NU_NIS_PESSOA": "120.00000.00-4",
    }


def contract(rng: random.Random, n: int, areas: list[int]) -> dict:
    return {
        "PROGRAMA": rng.choice(["far", "FDS", "PNHR", "FGTS"]), "NU_CPF_BENEFICIARIO": with_digits(100000000 + n),
        "NO_BENEFICIARIO": f"PESSOA NÚMERO {n}", "DT_NASCIMENTO": "10/10/1980", "VR_RENDA_FAMILIAR": f"{rng.randint(900, 9000)}",
        "CO_MUNICIPIO_IBGE": rng.choice(areas), "CO_CEP_IMOVEL": "70000-123",
        "DT_CONTRATACAO": f"2026-0{rng.randint(1, 8)}-15", "CO_FAIXA_RENDA": rng.randint(1, 4),
    }


def write_inbox(inbox: Path, families: int = 400) -> None:
    """Two months of files with the known defects."""
    inbox.mkdir(parents=True)
    rng = random.Random(17)
    areas = [municipality(n) for n in range(30)]
    reference = [
        {"CO_MUNICIPIO_IBGE": code, "NO_MUNICIPIO": f"Cidade {i}", "SG_UF": f"U{i % 6}", "CO_UF": i % 6,
         "NO_REGIAO": REGIONS[i % 5], "QT_POPULACAO": 4000 + 90 * i, "QT_DOMICILIOS": 1000 + 20 * i}
        for i, code in enumerate(areas)
    ]
    (inbox / "MUNICIPIOS.csv").write_text(lines(MUNICIPALITIES, reference), encoding="utf-8")
    deficit = [
        {"CO_MUNICIPIO_IBGE": code, "NU_ANO": year, "QT_DEFICIT_TOTAL": 40 + 3 * i + year % 7}
        for i, code in enumerate(areas) for year in (2019, 2022)
    ]
    # the header tolerates BOM, lower case and CR
    header = "﻿" + ";".join(DEFICIT.names).lower() + "\r"
    (inbox / "DEFICIT_FJP.csv").write_text(lines(DEFICIT, deficit, header), encoding="utf-8")

    for month, (day, updated) in enumerate([("11082026", "05/08/2026"), ("11092026", "05/09/2026")]):
        rows = [family(rng, n, areas, "01/03/2026") for n in range(1, families + 1)]
        if month:
            rows = rows[: families // 2]  # later rows vanish from the second file
            for row in rows[:20]:
                row["DT_ATUALIZACAO_FAM"] = updated
            rows += [family(rng, n, areas, updated) for n in range(families + 1, families + 11)]
        else:
            rows[0]["NU_CEP_LOGRADOURO_FAM"] = "7000\x000001"
            rows[1]["VL_RENDA_TOTAL_FAM"] = "-10"
            rows[2]["CD_IBGE_CADASTRO"] = "9999999"
            rows[3]["DT_ATUALIZACAO_FAM"] = "31/02/2026"
            rows[4]["QT_COMODOS_DOMIC_FAM"] = "dois"
            rows.append({**rows[5], "DT_ATUALIZACAO_FAM": "01/01/2020"})
        text = lines(FAMILY, rows)
        if not month:
            text += ";".join(["1"] * (len(FAMILY.names) - 5)) + "\n"
        (inbox / f"ARQ_FAMILIA_{day}_SB8.TXT").write_text(text, encoding="iso-8859-1")

        people = [person(rng, n, areas) for n in range(1, families + 1)]
        if not month:
            people[0]["NU_CPF_PESSOA"] = people[0]["NU_CPF_PESSOA"][:-1] + "x"
            people[1]["DT_NASC_PESSOA"] = "01/01/2099"
            people[2]["CO_CHV_NATURAL_PESSOA"] = ""
        (inbox / f"ARQ_PESSOA_{day}_SB8.TXT").write_text(lines(PERSON, people), encoding="iso-8859-1")

        contracts = [contract(rng, n, areas) for n in range(families - 60, families + 60)]
        contracts[0]["NU_CPF_BENEFICIARIO"] = "123"
        contracts[1]["PROGRAMA"] = "OUTRO"
        contracts[2]["NU_CPF_BENEFICIARIO"] = "529.982.247-25"
        contracts.append({**contracts[5], "PROGRAMA": "FDS" if contracts[5]["PROGRAMA"] != "FDS" else "FAR"})
        (inbox / f"BENEFICIARIOS_MCMV_{day}.csv").write_text(lines(CONTRACTS, contracts), encoding="utf-8")
