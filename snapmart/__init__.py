"""snapmart: repeated observations of online content, analysed on Spark."""
