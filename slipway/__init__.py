"""Query submissions as Spark data: decode, route, run, render, store and record."""

from slipway.operators.decode import decode_submissions, notebook_requests, route_submissions
from slipway.operators.execute import JobRegistry, run_sql
from slipway.operators.render import columns_document, inline_body, render, render_columns
from slipway.operators.runner import Runner
from slipway.operators.sinks import publish_connections, publish_global_view, read_result, write_result
from slipway.session import open_session, register_views, table_views
from slipway.sources.submissions import read_submission_stream, read_submissions
from slipway.streaming.submissions import stream_submissions

__all__ = [
    "JobRegistry", "Runner", "columns_document", "decode_submissions", "inline_body", "notebook_requests",
    "open_session", "publish_connections", "publish_global_view", "read_result", "read_submission_stream",
    "read_submissions", "register_views", "render", "render_columns", "route_submissions", "run_sql",
    "stream_submissions", "table_views", "write_result",
]
