"""pagelens: labelled image data from stored web pages, as Spark DataFrame jobs.

Layers:
  functions/  Column -> Column expressions (HTML regexes, entities, attributes,
              text analyzers, URL helpers). Pure Catalyst, no Python worker
              except the rare-entity decoder.
  operators/  DataFrame -> DataFrame building blocks (tokens, elements,
              regions, images, lines, term counts, links, ordered distinct).
  sources/    scans and sinks (stored pages, HTML files, URL lists, bulk
              NDJSON payloads, sectioned text/CSV reports).
  plans/      composite jobs (page images, article text, labelling v1-v3,
              link extraction, breadth-first crawl over stored pages).
  streaming/  the per-page labelling job run over arriving pages.
"""

from pagelens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
