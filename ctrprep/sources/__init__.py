"""Where frames come from and go to: tables, delimited text, model files, scratch."""
