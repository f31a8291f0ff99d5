"""corpusloom: a Spark-native engine for domain-stratified parallel corpora."""
