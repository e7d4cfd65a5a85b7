"""Ad-event and retail analytics as DataFrame-to-DataFrame Spark operators."""
