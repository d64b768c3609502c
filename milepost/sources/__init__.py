"""Where tables come from and go to: views, files, manifests and exports."""
