"""State of processing jobs (PRJ-28, PRJ-29)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import ColumnOrName, as_column, blank_to_null, digits, strip
from issuerlake.functions.display import fmt_text, format_cnpj

# The stages of the two flows, their labels, and the step that marks a stage as skipped.
TICKER_FLOW = [
    ("identidade", "Identidade", None),
    ("cvm", "CVM", "cvm_pulado"),
    ("mercado", "Mercado", None),
]
DOCUMENT_FLOW = [
    ("validacao_emissor", "Validação do emissor", None),
    ("peek_hashes", "Check de doc. duplicado", None),
    ("ia_quant", "Extração de DFs (IA)", None),
    ("ia_qual", "Transcrição de PDFs (IA)", None),
    ("finalizado", "Conclusão do cadastro", None),
]

# Statuses after which a job does not change, and the failed one.
TERMINAL = ["concluido", "concluido_com_erros", "erro"]
FAILED = "erro"

# Progress entries that steer the display and are not shown themselves.
CONTROL_ENTRIES = ["erros", "passos_concluidos", "mensagem_andamento", "mensagens_andamento"]


def _flow_states(flow, status: Column, stage: Column, done: Column) -> Column:
    keys = [key for key, _, _ in flow]
    here = F.coalesce(F.array_position(F.lit(keys), stage), F.lit(0)) - 1
    states = []
    for i, (key, shown, skip_step) in enumerate(flow):
        skipped = F.array_contains(done, skip_step) if skip_step else F.lit(False)
        at_stage = F.coalesce(stage == key, F.lit(False))
        state = (
            F.when(skipped, "pulada")
            .when(F.array_contains(done, key), "concluida")
            .when((status == FAILED) & at_stage, "falhou")
            .when(status.isin(TERMINAL), F.when((here >= 0) & (here >= i), "concluida").otherwise("pendente"))
            .when(at_stage, "atual")
            .when((here < 0) & F.lit(i == 0), "atual")
            .when((here >= 0) & (here > i), "concluida")
            .otherwise("pendente")
        )
        states.append(F.struct(F.lit(key).alias("key"), F.lit(shown).alias("label"), state.alias("state")))
    return F.array(*states)


def stage_states(status: ColumnOrName, stage: ColumnOrName, target: ColumnOrName, done_steps: ColumnOrName) -> Column:
    """PRJ-28: array of (key, label, state) over the flow the job belongs to.

    The flow follows from the stage, and from the shape of the target where the
    stage is unknown: a fourteen-digit target is a document job.
    """
    status = F.coalesce(as_column(status), F.lit(""))
    stage = F.lower(blank_to_null(stage))
    done = F.transform(F.coalesce(as_column(done_steps), F.array().cast("array<string>")), lambda s: F.lower(s))
    in_tickers = F.coalesce(stage.isin([k for k, _, _ in TICKER_FLOW]), F.lit(False))
    in_documents = F.coalesce(stage.isin([k for k, _, _ in DOCUMENT_FLOW]), F.lit(False))
    documents = in_documents | (~in_tickers & (F.length(digits(target)) >= 14))
    return F.when(documents, _flow_states(DOCUMENT_FLOW, status, stage, done)).otherwise(
        _flow_states(TICKER_FLOW, status, stage, done)
    )


def job_target(target: ColumnOrName, issuer_name: ColumnOrName) -> Column:
    """PRJ-29: struct(primary, secondary): issuer and masked id, else the raw target."""
    target = strip(F.coalesce(as_column(target), F.lit("")))
    name = blank_to_null(issuer_name)
    known = name.isNotNull() & (F.length(digits(target)) == 14)
    return F.struct(
        F.when(known, name).otherwise(fmt_text(target)).alias("primary"),
        F.when(known, format_cnpj(target)).alias("secondary"),
    )


def progress_entries(progress: ColumnOrName) -> Column:
    """PRJ-29: the entries of a progress map worth showing, as array of (key, value)."""
    progress = as_column(progress)
    has_name = F.coalesce(F.try_element_at(progress, F.lit("nome_emissor")) != "", F.lit(False))
    shown = F.map_filter(
        progress,
        lambda k, v: v.isNotNull()
        & ~k.isin(CONTROL_ENTRIES)
        & ~((k == "periodos_cvm") & has_name)
        & ~(k.isin("nome_emissor", "cnpj") & (v == "")),
    )
    return F.transform(
        F.map_entries(shown),
        lambda e: F.struct(
            e["key"].alias("key"),
            F.when(e["key"] == "cnpj", format_cnpj(e["value"])).otherwise(e["value"]).alias("value"),
        ),
    )
