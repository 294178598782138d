"""Import all query modules so that they register in the catalogue."""

from corpusmill.plans import (  # noqa: F401
    q_artifacts,
    q_files,
    q_manifest,
    q_mix,
    q_numeric,
    q_recipes,
    q_records,
    q_stream,
    q_text,
    q_tools,
)
