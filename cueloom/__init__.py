"""cueloom: Spark jobs that turn recordings and subtitles into a scored speech corpus."""
