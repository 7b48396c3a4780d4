"""Reading landed files, topics, layer tables and documents."""
