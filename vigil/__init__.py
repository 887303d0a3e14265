"""vigil: Spark-native scrutiny of shape-unstable public-record data.

Public API is DataFrame -> DataFrame and Column -> Column functions:

* ``vigil.functions`` — scalar/array/JSON expressions (``text.clean_string``,
  ``text.dequote``, ``text.decode_entities``, ``arrays.breadcrumb_dirs``,
  ``jsonx.json_array``, ``jsonx.unwrap_single_key``, ...);
* ``vigil.sources`` — scans and sinks (``nested_json.read_documents`` /
  ``records``, ``delimited.read_pipe_csv``, ``manifest.read_manifests``,
  ``files.read_landed``, ``pages.page_links``, ``markup.block_links``,
  ``split_text.read_json_records`` / ``read_quoted_csv``);
* ``vigil.operators`` — joins, aggregates, windows and flatteners
  (``coauthor.coauthor_weights``, ``quality.*``, ``histogram.group_histogram``,
  ``sequence.ordered_index`` / ``runs``, ``layout.seat_map``,
  ``frontier.expand_frontier``, ``manifest.pending`` / ``merge_results``,
  ``activity.flatten_activity``, ``initiative.split_initiatives``);
* ``vigil.streaming`` — incremental ingestion (``incremental.landed_file_stream``,
  ``content_stream``, ``ingest_available``, ``ingest_lot``);
* ``vigil.plans`` — scheduler entry points (``jobs.land_activity``,
  ``jobs.land_initiatives``, ``jobs.update_manifest``, ``jobs.activity_report``)
  and the query catalogue run by the correctness driver and the bench.

``vigil.session.build_session`` creates a session with AQE, skew-join and
checkpoint settings for large clusters.
"""

__version__ = "0.1.0"
