"""pagemill: corpora of marked-up wiki pages as Spark tables and plans."""
