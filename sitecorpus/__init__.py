"""Design, quality and reliability analytics over crawled site corpora, on PySpark."""
