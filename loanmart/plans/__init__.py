"""Report plans: declarative specs and composite report builders."""
