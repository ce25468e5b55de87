"""Training plans: driver loops over model-sized state whose every data-sized step is a Spark job."""
