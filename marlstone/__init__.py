"""Marlstone: a Spark-native engine for curating and evaluating labelled-sample datasets."""
