"""Where records come from and go to: landing files, the feature store and the watermark."""
