"""The registered queries of this subpackage."""

from plumbline.llm import (
    bpe,
    exact_dedup,
    fill_middle,
    filter_audit,
    html_text,
    mixing,
    pitman_yor,
    secret_scan,
    simhash,
    token_counts,
    topk_search,
    toxicity,
    warc,
)

QUERIES = [
    simhash.QUERY,
    bpe.QUERY,
    mixing.QUERY,
    token_counts.QUERY,
    topk_search.QUERY,
    warc.QUERY,
    exact_dedup.QUERY,
    html_text.QUERY,
    toxicity.QUERY,
    pitman_yor.QUERY,
    secret_scan.QUERY,
    fill_middle.QUERY,
    filter_audit.QUERY,
]
