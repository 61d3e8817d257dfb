"""Campaign rules against hits written out here: one match and one near miss for each rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortex.functions.rules import CAMPAIGN_RULES, CONVERSION_RULE

PLANS = "tim-controle-conheca-os-planos-e-promocoes"
DONE = [
    ("Event11", "dados-pessoais"), ("Event12", "criar-cadastro"), ("Event13", "endereco"), ("Event16", "pagamento-fatura-impressa"),
    ("Event17", "pagamento-express-impressa"), ("Event18", "pagamento-debito-impressa"), ("Event19", "pagamento-fatura-digital"),
    ("Event20", "pagamento-express-digital"), ("Event21", "pagamento-debito-digital"), ("Event22", "tim-negocia"), ("Event23", "sms"),
    ("Event24", "oferta-pre"), ("Event25", "oferta-express"),
]
CASES = [
    ("Event01", ("tim-controle-lp", None, "contratar-agora!"), ("tim-controle-lp", None, "contratar-agora")),
    ("Event02", (PLANS, "any", "contratar-agora"), (PLANS, "any", "Contratar-agora")),
    ("Event03", (PLANS, "tim-controle-planos", "mais-planos-controle"), (PLANS, None, "mais-planos-controle")),
    ("Event04", ("tim-controle-modal", None, "portabilidade-migracao"), ("tim-controle-modal", None, None)),
    ("Event05", (PLANS, None, "contratar-agora"), ("Tim-controle", None, "contratar-agora")),
    ("Event06", ("tim-controle-light-planos-tim", "tim-controle-light", "contratar-agora"), ("tim-controle-light-planos-tim", "light", "contratar-agora")),
    ("Event07", ("menu-principal", "menu-planos", "tim-controle"), ("menu-principal", "menu-planos", "controle")),
    ("Event08", ("home-para-voce", "banner-superior-item", "controle"), ("home-para-voce", "banner-superior-item", "CONTROLE")),
    ("Event09", ("home-para-voce-banner-central", None, None), ("home-para-voce", None, None)),
    ("Event10", ("menu-principal", "menu-planos", "controle"), ("menu-principal", "menu", "controle")),
    ("Event14", (None, None, "sucesso"), (None, None, "Sucesso")),
    ("Event15", ("ecommerce-chatbot", "adesao", "plano-cONTROLe-x"), ("ecommerce-chatbot", "adesao", "plano")),
    ("y_conversions", ("ecommerce", "adesao", "Controle"), ("ecommerce", "adesao", None)),
    *[(name, ("loja-Controle-x", action, "sucesso"), ("loja", action, "sucesso")) for name, action in DONE],
]


def test_every_rule_has_a_case():
    assert sorted(c[0] for c in CASES) == sorted(r.name for r in (*CAMPAIGN_RULES, CONVERSION_RULE))


@pytest.mark.parametrize("name, match, miss", CASES)
def test_match_and_near_miss(spark, name, match, miss):
    rule = {r.name: r for r in (*CAMPAIGN_RULES, CONVERSION_RULE)}[name]
    info = "struct<eventCategory:string,eventAction:string,eventLabel:string>"
    df = spark.createDataFrame([(match,), (miss,)], f"e {info}")
    got = [r[0] for r in df.select(F.coalesce(rule.predicate(F.col("e")), F.lit(False))).collect()]
    assert got == [True, False]
