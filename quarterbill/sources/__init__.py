"""Form tables in, report tables out."""
