"""Values that the oracle takes from the engine, pinned as literals: a change of one would change both sides alike."""

import hashlib

import pytest

from recfold import config as c
from recfold.operators import quality, reports
from recfold.plans import adapters


def digest(value):
    return hashlib.sha256(repr(value).encode()).hexdigest()[:16]


def test_marks_and_tokens():
    assert (c.FATAL_MARKS, c.INJURED_MARKS, c.UNHURT_MARKS) == (["FATAL"], ["COM LESOES", "GRAVE", "LEVE"], ["SEM LESOES", "ILESO"])
    assert (c.SEJUSP, c.DER, c.WAZE, c.STRONG, c.POSSIBLE, c.MISSING_ID) == ("SEJUSP", "DER", "WAZE", "FORTE", "POSSIVEL", "NaN")
    assert len(c.NA_TOKENS) == 19 and {"", "NA", "NaN", "null", "None", "#N/A", "<NA>"} <= set(c.NA_TOKENS)
    assert (c.EXPECTED_INPUT_ROWS, c.PREVIOUS_TOTAL, c.SENSITIVITY_MERGED) == (3567394, 3546719, 180126)


def test_check_texts():
    assert len(quality.CHECK_TEXTS) == 29 and digest(quality.CHECK_TEXTS) == "97c950f4e45304df"
    assert [check[0] for check in quality.CHECK_TEXTS if check[0].startswith("QA_")] == [
        *(f"QA_0{n}" for n in range(1, 10)), *(f"QA_{n}" for n in range(11, 18))]
    assert quality.COMPARISONS["QA_01"].passes == "n_entrada = p_entrada"
    assert digest(sorted(quality.COMPARISONS)) == "8614754870628083"


def test_report_labels():
    assert reports.SUMMARY_LABELS == {
        "n_entrada": "Total de Registros Entrada", "n_final": "Total Acidentes Unicos Final",
        "n_veiculos": "Qtd Veiculos Agregados", "n_envolvidos": "Qtd Envolvidos Agregados",
    }
    assert reports.SENSITIVITY_TEXT == "Estimado conservadoramente: "


@pytest.mark.parametrize("name, value", [
    ("delimited_lines", "7cdaf9ad8159db14"), ("broken_lines", "67cb97b12887f47b"), ("base", "6ebdf2055fbed7ca"),
    ("der_ocorrencia", "019bce14ea431066"), ("der_veiculos", "b68f86cd2020fee0"), ("der_envolvidos", "4085468d1cb276e6"),
    ("der_cond_acidente", "e0d0b50b2fdede90"), ("der_cond_via", "df1273dc11996f21"), ("der_embriaguez", "fec63a71d2434b02"),
])
def test_adapters(name, value):
    """The text that both engines run; change the digest with it, knowingly."""
    assert digest(adapters.INPUTS[name]) == value
