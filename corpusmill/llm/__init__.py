"""Training-data operators (decontamination, quality, language, mixing, dedup, output, LM).

Nothing outside this subpackage imports it; ``corpusmill.llm.queries`` registers the
``opN_*`` queries and ``corpus_pipeline.py`` composes five of the operators.
"""
