"""Named queries (insights, dashboards), the table catalog and the pipeline runner."""
