"""A layered warehouse as Spark jobs: raw files, clean typed tables, quality gates, star schema, KPI views."""
