"""Canonical names of technologies."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkloom.functions.text import interleave

#: Aliases and the names that replace them.
CANONICAL = {
    "k8s": "Kubernetes", "kube": "Kubernetes", "kubernetes": "Kubernetes", "otel": "OpenTelemetry", "open telemetry": "OpenTelemetry",
    "opentelemetry": "OpenTelemetry", "prom": "Prometheus", "prometheus": "Prometheus", "argocd": "Argo CD", "argo cd": "Argo CD",
    "argo-cd": "Argo CD", "argo workflows": "Argo Workflows", "istio": "Istio", "envoy": "Envoy", "envoy proxy": "Envoy", "cilium": "Cilium",
    "ebpf": "eBPF", "e-bpf": "eBPF", "bpf": "eBPF", "containerd": "containerd", "crio": "CRI-O", "cri-o": "CRI-O", "helm": "Helm",
    "kustomize": "Kustomize", "fluxcd": "Flux", "flux cd": "Flux", "flux": "Flux", "linkerd": "Linkerd", "knative": "Knative", "k-native": "Knative",
    "grpc": "gRPC", "etcd": "etcd", "coredns": "CoreDNS", "core dns": "CoreDNS", "falco": "Falco", "opa": "Open Policy Agent",
    "open policy agent": "Open Policy Agent", "kyverno": "Kyverno", "backstage": "Backstage", "crossplane": "Crossplane", "dapr": "Dapr",
    "keda": "KEDA", "tekton": "Tekton", "harbor": "Harbor", "rook": "Rook", "longhorn": "Longhorn", "thanos": "Thanos", "cortex": "Cortex",
    "grafana": "Grafana", "jaeger": "Jaeger", "zipkin": "Zipkin", "cert-manager": "cert-manager", "certmanager": "cert-manager",
    "cert manager": "cert-manager", "vitess": "Vitess", "spiffe": "SPIFFE", "spire": "SPIRE", "buildpacks": "Cloud Native Buildpacks",
    "cnb": "Cloud Native Buildpacks", "cloud native buildpacks": "Cloud Native Buildpacks", "kubevirt": "KubeVirt", "kube virt": "KubeVirt",
    "volcano": "Volcano", "gateway api": "Gateway API", "wasm": "WebAssembly", "webassembly": "WebAssembly", "web assembly": "WebAssembly",
    "terraform": "Terraform", "tf": "Terraform", "opentofu": "OpenTofu", "open tofu": "OpenTofu", "pulumi": "Pulumi", "docker": "Docker",
    "podman": "Podman", "aws": "AWS", "amazon web services": "AWS", "gcp": "GCP", "google cloud": "GCP", "google cloud platform": "GCP",
    "azure": "Azure", "microsoft azure": "Azure", "kubeflow": "Kubeflow", "kube flow": "Kubeflow", "velero": "Velero", "trivy": "Trivy",
    "cosign": "Cosign", "sigstore": "Sigstore", "hami": "HAMi", "hemi": "HAMi", "perses": "Perses", "persis": "Perses", "kagent": "Kagent",
    "k-agent": "Kagent", "solo.io": "Solo.io", "solodial": "Solo.io", "gloo": "Gloo", "headlamp": "Headlamp", "kubevela": "KubeVela",
    "kube vela": "KubeVela", "karmada": "Karmada", "openkruise": "OpenKruise", "kruise": "OpenKruise", "strimzi": "Strimzi", "keptn": "Keptn",
    "inspektor gadget": "Inspektor Gadget", "kubescape": "Kubescape", "litmus": "LitmusChaos", "litmuschaos": "LitmusChaos",
    "litmus chaos": "LitmusChaos", "vcluster": "vCluster", "kata containers": "Kata Containers", "kata": "Kata Containers",
}

#: Longest alias first, so that no alias hides a longer one that begins like it.
PATTERN = r"(?iU)\b(?:" + "|".join(re.escape(a).replace("\\ ", " ") for a in sorted(CANONICAL, key=len, reverse=True)) + r")\b"


def canonical(x: Column | str) -> Column:
    """Aliases become names in a single pass, whatever their case, at word boundaries."""
    names = F.create_map(*(F.lit(v) for pair in CANONICAL.items() for v in pair))
    return interleave(x, PATTERN, lambda m: F.try_element_at(names, F.lower(m)))


def _struct(fields: list[str], names: list[str]) -> Callable[[Column], Column]:
    def each(x: Column) -> Column:
        return F.struct(*(canonical(x[f]).alias(f) if f in names else x[f].alias(f) for f in fields))

    return each


def canonical_talk(talks):
    """Canonical names in the four fields of a talk analysis that hold technologies."""
    kinds = {f.name: f.dataType for f in talks.schema.fields}
    changed = {}
    if "tools_and_projects" in kinds:
        changed["tools_and_projects"] = F.transform("tools_and_projects", canonical)
    for column, names in (("maturity_assessments", ["technology"]), ("technology_stance", ["technology"]), ("relationships", ["entity_a", "entity_b"])):
        if column in kinds:
            fields = kinds[column].elementType.fieldNames()
            changed[column] = F.transform(column, _struct(fields, names))
    return talks.withColumns(changed)
