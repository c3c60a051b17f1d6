"""Tables of the credit model: columns, natural keys, parents and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "n": T.DoubleType(), "i": T.LongType(), "d": T.DateType(), "t": T.TimestampType(), "j": T.VariantType()}


def _table(spec: str) -> T.StructType:
    """``name:type`` pairs; s text, n number, i integer, d date, t timestamp, j semi-structured."""
    pairs = [item.split(":") for item in spec.split()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns, keys, references and domains as the stored tables have them.
TABLES = {
    "emissores": _table(
        "cnpj:s cod_cvm:s nome:s categoria_cvm:s tipo_capital:s ticker_acao:s grupo_economico:s setor:s observacao:s"
        " criado_em:t atualizado_em:t"
    ),
    "demonstracoes_financeiras": _table(
        "cnpj:s data_ref:d tipo_doc:s demonstracao:s cd_conta:s ds_conta:s valor:n criado_em:t"
    ),
    "deb_caracteristicas": _table(
        "cnpj:s ticker_deb:s nome_emissor:s tipo:s serie:s numero_emissao:i data_emissao:d data_vencimento:d"
        " data_primeiro_pagamento:d prazo_anos:n volume_emissao:n valor_unitario_emissao:n quantidade_debentures:i"
        " indexador:s spread_emissao:n taxa_prefixada:n periodicidade_juros:s periodicidade_amort:s especie:s garantias:s"
        " garantidores:s lei_incentivo:s banco_coordenador:s banco_estruturador:s agente_fiduciario:s banco_liquidante:s"
        " rating_emissao:s agencia_rating:s data_ultimo_rating:d perspectiva_rating:s status:s isin:s codigo_cetip:s"
        " dados_anbima:j criado_em:t atualizado_em:t"
    ),
    "deb_agenda": _table(
        "ticker_deb:s cnpj:s data_evento:d data_liquidacao:d data_base:d evento:s evento_arc:s taxa:n valor:n status:s"
        " grupo_status:s criado_em:t"
    ),
    "deb_historico_diario": _table(
        "ticker_deb:s data_referencia:d pu_par:n vna:n juros:n prazo_remanescente:i pu_indicativo:n taxa_indicativa:n"
        " taxa_compra:n taxa_venda:n duration_dias_uteis:n desvio_padrao:n percentual_pu_par:n percentual_vne:n"
        " intervalo_indicativo_min:n intervalo_indicativo_max:n referencia_ntnb:s spread_indicativo:n"
        " volume_financeiro:n quantidade_negocios:i quantidade_titulos:i taxa_media_negocios:n pu_medio_negocios:n"
        " reune:s percentual_reune:n pu_indicativo_status:s taxa_indicativa_status:s flag_status:s"
        " data_ultima_atualizacao:d criado_em:t"
    ),
    "emissor_compendio_qualitativo": _table("cnpj:s nome_arquivo:s hash_md5:s titulo:s markdown_conteudo:s criado_em:t"),
    "emissor_compendio_quantitativo": _table("cnpj:s nome_arquivo:s hash_md5:s titulo:s criado_em:t"),
    "emissor_analise_credito": _table("cnpj:s analise_markdown:s delta_markdown:s metadados:j criado_em:t"),
    "pipeline_jobs": _table("id:s tipo:s alvo:s status:s etapa_atual:s progresso:j erro:s criado_em:t atualizado_em:t"),
}

KEYS = {
    "emissores": ["cnpj"],
    "demonstracoes_financeiras": ["cnpj", "data_ref", "tipo_doc", "demonstracao", "cd_conta"],
    "deb_caracteristicas": ["ticker_deb"],
    "deb_agenda": ["ticker_deb", "data_evento", "evento", "data_base"],
    "deb_historico_diario": ["ticker_deb", "data_referencia"],
    "emissor_compendio_qualitativo": ["cnpj", "hash_md5"],
    "emissor_compendio_quantitativo": ["cnpj", "hash_md5"],
    "pipeline_jobs": ["id"],
}

# The first generation keyed events without their base date.
AGENDA_KEY_V1 = ["ticker_deb", "data_evento", "evento"]

PARENTS = [
    ("demonstracoes_financeiras", "emissores", ["cnpj"]),
    ("deb_caracteristicas", "emissores", ["cnpj"]),
    ("deb_agenda", "emissores", ["cnpj"]),
    ("deb_agenda", "deb_caracteristicas", ["ticker_deb"]),
    ("deb_historico_diario", "deb_caracteristicas", ["ticker_deb"]),
    ("emissor_compendio_qualitativo", "emissores", ["cnpj"]),
    ("emissor_compendio_quantitativo", "emissores", ["cnpj"]),
    ("emissor_analise_credito", "emissores", ["cnpj"]),
]

REQUIRED = {
    "emissores": ["nome"],
    "demonstracoes_financeiras": ["cnpj", "data_ref", "tipo_doc", "demonstracao", "cd_conta"],
    "deb_caracteristicas": ["cnpj", "ticker_deb"],
    "deb_agenda": ["ticker_deb", "cnpj", "data_evento", "evento"],
    "deb_historico_diario": ["ticker_deb", "data_referencia"],
    "emissor_compendio_qualitativo": ["cnpj", "nome_arquivo", "hash_md5", "markdown_conteudo"],
    "emissor_compendio_quantitativo": ["cnpj", "nome_arquivo", "hash_md5"],
    "emissor_analise_credito": ["cnpj", "analise_markdown"],
    "pipeline_jobs": ["tipo", "alvo", "status"],
}

DOMAINS = {
    ("demonstracoes_financeiras", "tipo_doc"): ["DFP", "ITR"],
    ("demonstracoes_financeiras", "demonstracao"): ["BPA", "BPP", "DRE", "DFC", "DVA"],
    ("deb_caracteristicas", "tipo"): ["debenture", "ccb", "cri", "cra", "outros"],
    ("deb_caracteristicas", "status"): ["ativo", "resgatado", "vencido", "default"],
    ("pipeline_jobs", "tipo"): ["cadastro", "analise"],
    ("pipeline_jobs", "status"): ["pendente", "rodando", "concluido", "concluido_com_erros", "erro"],
}
