"""Training-data pipeline operators (decontamination, packing, language ID,
nearest neighbours, secret scans, token counts, license scans, n-gram joins,
language-model scoring, sharding).

Nothing outside this subpackage imports it except the entry module and
``corpus_pipeline.py``.
"""
