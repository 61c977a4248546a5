"""One query per operation, with SQL where SQL can express it."""

from __future__ import annotations

from millrace.llm import decontaminate, divergence, licenses, mixing, neighbours, periodic, pieces, pii, quality, records, simhash, toxicity, warc

QUERIES = {
    "op6_licenses": licenses.op6_licenses,
    "op7_mixing": mixing.op7_mixing,
    "op3_pii": pii.op3_pii,
    "op8_neighbours": neighbours.op8_neighbours,
    "op10_toxicity": toxicity.op10_toxicity,
    "op2_simhash": simhash.op2_simhash,
    "op5_quality": quality.op5_quality,
    "op4_warc": warc.op4_warc,
    "op1_token_records": records.op1_token_records,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op11_pieces": pieces.op11_pieces,
    "op12_periodic": periodic.op12_periodic,
    "op13_divergence": divergence.op13_divergence,
}

ORACLES = {
    "op4_warc": warc.OP4_SQL,
    "op9_decontaminate": decontaminate.OP9_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
