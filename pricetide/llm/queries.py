"""Registered queries of the training-data operators."""

from __future__ import annotations

from pricetide.llm.ann import Q_NEIGHBOURS_SQL, q_neighbours
from pricetide.llm.chat import q_chat
from pricetide.llm.collocations import Q_COLLOCATIONS_SQL, q_collocations
from pricetide.llm.decontam import Q_DECONTAMINATION_SQL, q_decontamination
from pricetide.llm.langid import q_language
from pricetide.llm.mixing import q_mixing
from pricetide.llm.ranking import Q_RANKED_SEARCH_SQL, q_ranked_search
from pricetide.llm.secrets import q_secrets
from pricetide.llm.simhash import q_simhash
from pricetide.llm.tokenids import q_token_ids
from pricetide.llm.toxicity import q_toxicity
from pricetide.llm.urlfilter import Q_URLS_SQL, q_urls
from pricetide.llm.warc import Q_WARC_SQL, q_warc

QUERIES = {
    "op1_mixing": q_mixing,
    "op2_decontamination": q_decontamination,
    "op3_simhash": q_simhash,
    "op4_warc": q_warc,
    "op5_neighbours": q_neighbours,
    "op6_toxicity": q_toxicity,
    "op7_language": q_language,
    "op8_chat": q_chat,
    "op9_secrets": q_secrets,
    "op10_urls": q_urls,
    "op11_collocations": q_collocations,
    "op12_token_ids": q_token_ids,
    "op13_ranked_search": q_ranked_search,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": Q_DECONTAMINATION_SQL,
    "op4_warc": Q_WARC_SQL,
    "op5_neighbours": Q_NEIGHBOURS_SQL,
    "op10_urls": Q_URLS_SQL,
    "op11_collocations": Q_COLLOCATIONS_SQL,
    "op13_ranked_search": Q_RANKED_SEARCH_SQL,
}
